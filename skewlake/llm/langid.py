"""Language identification with a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, byte_slices, plain

#: Bounds of the training sample: documents of each language, spans of each document.
DOCUMENTS, SPANS = 300, 16
#: Hidden units of a layer for every 16 labels (32 at most); bytes of a training span; steps and spans of each.
HIDDEN, SPAN, STEPS, BATCH = 8, 64, 320, 128
#: Texts are read in pieces of so many bytes, each layer beginning so many bytes before (or after) its piece.
PIECE, CONTEXT = 128, 16
#: The code beside a text's ends: it leaves a layer that has read nothing yet as it is.
PAD = 256
LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    """Whether a text holds a letter. The pattern also takes number signs such as ² or Ⅷ, so what it finds is looked at."""
    return text is not None and any(m.group().isalpha() for m in LETTER.finditer(text))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the doc_id as text leaves 1 when divided by 3 (a null doc_id: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Two gated recurrent layers over the bytes of a text, one from either end, and a softmax at each byte.

    Each layer: x holds a row of 3 * hidden for every byte value (input weights and bias), u the recurrent weights.
    """

    def __init__(self, labels: list[str], seed: int = 7, hidden: int = 2 * HIDDEN):
        rng = np.random.default_rng(seed)
        self.labels, self.hidden = labels, hidden
        self.p = {f"x{d}": rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32) for d in "fb"}
        self.p |= {f"u{d}": rng.normal(0, hidden**-0.5, (hidden, 3 * hidden)).astype(np.float32) for d in "fb"}
        self.p |= {"v": rng.normal(0, 0.2, (2 * hidden, len(labels))).astype(np.float32), "c": np.zeros(len(labels), np.float32)}

    def _layer(self, d: str, codes: np.ndarray) -> tuple[np.ndarray, list]:
        """codes: spans by position. States after each byte, and what backpropagation needs."""
        x, u, n = np.concatenate([self.p[f"x{d}"], np.zeros((1, 3 * self.hidden), np.float32)]), self.p[f"u{d}"], self.hidden
        h = np.zeros((codes.shape[0], n), x.dtype)
        out, tape = np.empty((codes.shape[1], codes.shape[0], n), x.dtype), []
        for t in range(codes.shape[1]):
            a, r = x[codes[:, t]], h @ u
            g = _sigmoid(a[:, : 2 * n] + r[:, : 2 * n])
            z, reset = g[:, :n], g[:, n:]
            new = np.tanh(a[:, 2 * n :] + reset * r[:, 2 * n :])
            tape.append((h, z, reset, new, r[:, 2 * n :]))
            h = new + z * (h - new)
            out[t] = h
        return out, tape

    def gradients(self, codes: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over all positions of texts, and its gradients by backpropagation through time."""
        codes = codes.astype(np.int64)
        forward, ft = self._layer("f", codes)
        backward, bt = self._layer("b", codes[:, ::-1])
        aligned = backward[::-1]
        score = forward @ self.p["v"][: self.hidden] + aligned @ self.p["v"][self.hidden :] + self.p["c"]
        p = np.exp(score - score.max(-1, keepdims=True))
        p /= p.sum(-1, keepdims=True)
        n, real = len(codes), (codes.T != PAD)[:, :, None]
        many = max(1, int(real.sum()))
        loss = -float((np.log(p[:, np.arange(n), label] + 1e-9) * real[:, :, 0]).sum()) / many
        d = p.copy()
        d[:, np.arange(n), label] -= 1
        d *= real / many
        v = self.p["v"]
        flat = d.reshape(-1, d.shape[2])
        g = {"c": flat.sum(0), "v": np.concatenate([s.reshape(-1, self.hidden).T @ flat for s in (forward, aligned)])}
        for way, tape, dh, seq in (("f", ft, d @ v[: self.hidden].T, codes), ("b", bt, (d @ v[self.hidden :].T)[::-1], codes[:, ::-1])):
            u = self.p[f"u{way}"]
            steps, gu, carry = np.empty((len(tape), n, 3 * self.hidden), u.dtype), np.zeros_like(u), np.zeros((n, self.hidden), u.dtype)
            for k in range(len(tape) - 1, -1, -1):
                h, z, reset, new, r = tape[k]
                carry = carry + dh[k]
                dnew = carry * (1 - z) * (1 - new * new)
                dz = carry * (h - new) * z * (1 - z)
                dr = dnew * r * reset * (1 - reset)
                steps[k] = np.concatenate([dz, dr, dnew], 1)
                du = np.concatenate([dz, dr, dnew * reset], 1)
                gu += h.T @ du
                carry = carry * z + du @ u.T
            code = seq.T.ravel()
            order = np.argsort(code, kind="stable")
            held, first = np.unique(code[order], return_index=True)
            gx = np.zeros((PAD + 1, 3 * self.hidden), u.dtype)
            gx[held] = np.add.reduceat(steps.reshape(-1, 3 * self.hidden)[order], first)
            g |= {f"x{way}": gx[:PAD], f"u{way}": gu}
        return loss, g

    def fit(self, spans: list[bytes], label: np.ndarray, steps: int = STEPS, seed: int = 11) -> list[float]:
        """Adam over batches of spans, labels balanced."""
        rng = np.random.default_rng(seed)
        weight = 1.0 / np.bincount(label, minlength=len(self.labels))[label]
        codes = np.full((len(spans), SPAN), PAD, np.int16)
        for i, x in enumerate(spans):
            codes[i, : len(x)] = LOWER[np.frombuffer(x, np.uint8)]
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        share, losses = weight / weight.sum(), []
        for step in range(1, steps + 1):
            pick = rng.choice(len(spans), BATCH, p=share)
            loss, g = self.gradients(codes[pick], label[pick])
            losses.append(loss)
            rate = 0.02 * (1 - 0.9 * step / steps)
            for k, v in g.items():
                m[k] = 0.9 * m[k] + 0.1 * v
                s[k] = 0.99 * s[k] + 0.01 * v * v
                self.p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
        return losses

    def _read(self, codes: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """Sums of label probabilities over the bytes of each piece.

        codes: pieces by CONTEXT bytes, the piece's own, and CONTEXT bytes; inside: which of its own are bytes of the text. Both
        layers take a step at a time together; gates are written with tanh alone, their halves put into the weights.
        """
        n, own, H = len(codes), inside.shape[1], self.hidden
        x = np.concatenate([y for d in "fb" for y in (self.p[f"x{d}"], np.zeros((1, 3 * H), np.float32))])
        u = np.stack([self.p["uf"], self.p["ub"]])
        xz, xr, xn = (np.ascontiguousarray(x[:, k * H : (k + 1) * H] * f) for k, f in ((0, 0.5), (1, 0.5), (2, 1)))
        uz, ur, un = (np.ascontiguousarray(u[:, :, k * H : (k + 1) * H] * np.float32(0.5)) for k in range(3))
        steps = CONTEXT + own
        seq = np.stack([codes[:, :steps].T, codes[:, CONTEXT:].T[::-1] + (PAD + 1)], 1)
        h, states = np.zeros((2, n, H), np.float32), np.empty((own, 2, n, H), np.float32)
        a, b, c, part = (np.empty((2, n, H), np.float32) for _ in range(4))
        for t in range(steps):
            at = seq[t]
            for gate, u_, x_ in ((a, uz, xz), (b, ur, xr)):
                np.take(x_, at, axis=0, out=gate, mode="clip")
                np.matmul(h, u_, out=part)
                gate += part
                np.tanh(gate, out=gate)
            np.matmul(h, un, out=part)
            np.take(xn, at, axis=0, out=c, mode="clip")
            b *= part
            c += part
            c += b
            np.tanh(c, out=c)  # the new state; a: 2 * update gate - 1
            np.subtract(h, c, out=b)
            a *= b
            c += h
            c += a
            h = c * np.float32(0.5)
            if t >= CONTEXT:
                states[t - CONTEXT] = h
        v = self.p["v"]
        score = v[:H].T @ np.ascontiguousarray(states[:, 0]).reshape(-1, H).T + v[H:].T @ np.ascontiguousarray(states[::-1, 1]).reshape(-1, H).T + self.p["c"][:, None]
        score -= score.max(0)
        np.exp(score, out=score)
        score *= inside.T.reshape(1, -1) / score.sum(0)
        return score.reshape(-1, own, n).sum(1).T

    def documents(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Sums of label probabilities over all bytes of each text, and the number of bytes.

        Texts are read in pieces of PIECE bytes from their beginning, each layer with CONTEXT bytes before it; a text of up to
        PIECE bytes is so read in one go.
        """
        raw = [b"" if t is None else t for t in texts.cast(pa.large_binary()).to_pylist()]
        size = np.array([len(t) for t in raw], np.int64)
        end = np.cumsum(size)
        data = LOWER[np.frombuffer(b"".join(raw), np.uint8)].astype(np.int16)
        del raw
        pieces = -(-size // PIECE)
        text = np.repeat(np.arange(len(size)), pieces)
        turn = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = (end - size)[text] + turn * PIECE
        own = np.minimum(PIECE, end[text] - begin)
        out = np.zeros((len(size), len(self.labels)))
        order = np.argsort(own, kind="stable")
        batch = max(16, min(1024, 16384 // len(self.labels)))
        for i in range(0, len(order), batch):
            take = order[i : i + batch]
            most = int(own[take[-1]])
            at = begin[take][:, None] + np.arange(-CONTEXT, most + CONTEXT)
            of = text[take][:, None]
            codes = np.where((at >= (end - size)[of]) & (at < end[of]), data[np.clip(at, 0, len(data) - 1)], np.int16(PAD))
            np.add.at(out, text[take], self._read(codes, np.arange(most) < own[take][:, None]))
        return out, size


def _draw(batches):
    """Up to SPANS spans of SPAN bytes of each document, evenly spaced over the whole text."""
    for b in batches:
        out = []
        for text in b.column("text").to_pylist():
            raw = text.encode()
            many = min(SPANS, -(-len(raw) // SPAN))
            last = max(0, len(raw) - SPAN)
            out.append([raw[a : a + SPAN] for a in (i * last // max(1, many - 1) for i in range(many))])
        yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("rank"), pa.array(out, pa.list_(pa.binary()))], ["lang", "rank", "spans"])


def train(docs: DataFrame, steps: int = STEPS) -> Network | None:
    """Fit on a bounded sample: up to DOCUMENTS labelled documents (by hash of doc_id) of every label.

    None if no document has both a label and a text. Held-out documents are never read.
    """
    known = plain(docs, doc_id="long", text="string", lang="string").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).withColumn("rank", F.xxhash64("doc_id"))
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    span = 1 << 40
    share = F.least(F.lit(1.0), F.lit(2 * DOCUMENTS + 100) / F.col("n")) * span
    some = known.join(F.broadcast(counts), "lang").filter(F.pmod("rank", F.lit(span)) < share)
    few = some.withColumn("turn", F.row_number().over(Window.partitionBy("lang").orderBy("rank", "doc_id", "text"))).filter(F.col("turn") <= DOCUMENTS)
    rows = few.select("lang", "rank", "text").mapInArrow(_draw, "lang string, rank long, spans array<binary>").collect()
    rows.sort(key=lambda r: (r["lang"], r["rank"], r["spans"]))
    labels = sorted({r["lang"] for r in rows if r["spans"]})
    if not labels:
        return None
    net = Network(labels, hidden=min(32, HIDDEN * -(-len(labels) // 16)))
    if len(labels) > 1:
        at = {k: i for i, k in enumerate(labels)}
        net.fit([bytes(x) for r in rows for x in r["spans"]], np.repeat([at[r["lang"]] for r in rows], [len(r["spans"]) for r in rows]), steps)
    return net


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, lang_pred, score for each row: the label with the greatest mean probability over all byte positions.

    Only the text is read, whole. Null text, or a text without letters: `und` with score 1. Without a trained network every
    text is `und` with score 0. Ties go to the label that sorts first. Rows that repeat are each judged; an empty table
    gives no rows; extra columns are not read.
    """

    def run(batches):
        for b in byte_slices(batches, 4 << 20):
            texts = b.column("text").to_pylist()
            lettered = np.array([has_letter(t) for t in texts], bool)
            label, score = np.full(len(texts), "und", object), np.where(lettered, 0.0, 1.0)
            if net and lettered.any():
                total, count = net.documents(b.column("text"))
                best = total.argmax(1)
                label = np.where(lettered, np.array(net.labels, object)[best], "und")
                mean = total[np.arange(len(best)), best] / np.maximum(count, 1)
                score = np.where(lettered, np.clip(mean, 0, 1), 1.0)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(label.tolist(), pa.string()), pa.array(score.astype(float))], ["doc_id", "lang_pred", "score"])

    return plain(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_known(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """The documents, with all their columns, whose language is told with a score of at least `least`; `und` goes.

    The network is trained on these documents' labels (held-out ones excepted); a document's own label never counts.
    """
    net = train(docs)

    @F.arrow_udf("boolean")
    def known(texts: pa.Array) -> pa.Array:
        out = []
        for b in byte_slices([pa.RecordBatch.from_arrays([texts], ["text"])], 4 << 20):
            lettered = np.array([has_letter(t) for t in b.column("text").to_pylist()], bool)
            if net and lettered.any():
                total, count = net.documents(b.column("text"))
                lettered &= total.max(1) >= least * np.maximum(count, 1)
            out.append(pa.array(lettered & bool(net), pa.bool_()))
        return pa.concat_arrays(out)

    return docs.filter(known(F.col("text").cast("string")))


def op10_language_id(docs: DataFrame) -> DataFrame:
    return identify(docs, train(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
