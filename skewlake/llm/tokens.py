"""Token ids by the tokenizers library, with the runs between white space encoded once and kept."""

from __future__ import annotations

import json
import os
from array import array

#: Runs of a generation: a table holds the present generation and the one before, so what is in use stays.
KEPT = 400_000
#: Longer runs aren't kept, so that the table's size is bounded.
LONGEST = 64
#: Signs that may follow a word; with them split off, the word itself is often known.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def byte_letters() -> dict[int, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from 256 on in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}


_OPEN: dict[str, Encoder] = {}


class Runs(dict):
    """Ids of runs without white space, each with `lead` before it, encoded when first asked for.

    A run of Latin-1 letters, and signs after it, is one pre-token and perhaps a second of signs: the first is given
    straight to the library's model (such letters are normalised by lowering alone). Any other run is encoded whole.
    """

    def __init__(self, owner: Encoder, lead: str = "", lower: bool = False):
        self.owner, self.lead, self.lower, self.signs, self.before = owner, lead, lower, {}, {}

    def __missing__(self, run: str | bytes) -> bytes | None:
        out = self.before.get(run, self)
        if out is self:
            out = self._encode(run if isinstance(run, str) else run.decode(), type(run))
        if len(run) <= LONGEST:
            if len(self) >= KEPT:
                self.before = dict(self)
                self.clear()
            self[run] = out
        return out

    def _encode(self, run: str, kind: type) -> bytes | None:
        owner = self.owner
        if owner.kind == "blank":
            if run[:1] == "\n":
                ids = owner.first[run[1:]]
                return None if ids is None else owner.line + ids
            # white space of another kind at the edge of a run may belong to a longer run: such texts are encoded whole
            if run[:1].isspace() or run[-1:].isspace():
                return None
        word = run.rstrip(SIGNS)
        if not (word.isalpha() and (word.isascii() or max(word) < "\u0100")):
            return owner.whole(self.lead + run)
        if len(word) < len(run):
            signs = run[len(word) :]
            return self[word if kind is str else word.encode()] + self._signs(signs)
        text = self.lead + (word.lower() if self.lower else word)
        return array("I", [t.id for t in owner.model.tokenize(text.encode().decode("latin-1").translate(owner.letters))]).tobytes()

    def _signs(self, signs: str) -> bytes:
        out = self.signs.get(signs)
        if out is None:
            out = self.owner.whole(signs)
            if len(signs) <= LONGEST:
                if len(self.signs) >= KEPT:
                    self.signs.clear()
                self.signs[signs] = out
        return out


class Encoder:
    """Ids of whole texts, equal to those that the library gives for the text (no added special tokens).

    A run between white space is encoded by the library once and kept. This is exact for two kinds of tokenizer, which are
    told by their file: those that drop white space (kind "dropped"; special tokens hold no white space, and no normaliser
    step joins characters across it), and byte-level ones whose pieces take one blank before a word (kind "blank"; texts
    with longer runs of white space, or white space at an end, go to the library whole). Any other file (kind "whole") has
    every text encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        pre, norm = spec["pre_tokenizer"] or {}, spec["normalizer"]
        parts = pre.get("pretokenizers", [])
        plain_norm = norm is None or all(x["type"] in ("NFC", "Lowercase") or x["type"] == "Replace" and x["pattern"] == {"Regex": r"\s+"} and x["content"] == " " for x in norm.get("normalizers", [norm]))
        apart = not any(c.isspace() for s in self.special for c in s) and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        self.kind = "whole"
        if apart and plain_norm and len(parts) == 2 and parts[0]["type"] == "Split" and parts[0]["behavior"] == "Removed" and parts[0]["invert"] and parts[0]["pattern"] == {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}:
            self.kind = "dropped"
        elif norm is None and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
            self.kind = "blank"
        self.model, self.letters = self.library.model, byte_letters()
        self.line = self.whole("\n")
        self.runs, self.first, self.after = Runs(self, lower=True), Runs(self), Runs(self, " ")

    def forget(self) -> None:
        """Drop the word tables."""
        for table in (self.runs, self.first, self.after):
            for held in (table, table.before, table.signs):
                held.clear()

    def whole(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text, one after the other; null is empty."""
        one = {"dropped": self._dropped, "blank": self._blank, "whole": self.whole}[self.kind]
        return [one(t) if t else b"" for t in texts]

    def _dropped(self, text: str) -> bytes:
        return b"".join(map(self.runs.__getitem__, text.encode().split()))

    def pieces(self, runs: list[bytes]) -> list[int]:
        """Number of ids of each run (kind "dropped"), each counted once."""
        return [len(self.runs[x]) // 4 for x in runs]

    def _blank(self, text: str) -> bytes:
        if text[0] in " \n" or text[-1] in " \n" or "  " in text or " \n" in text or "\n " in text or "\n\n" in text or any(s in text for s in self.special):
            return self.whole(text)
        head, *rest = text.replace("\n", " \n").split(" ")
        try:
            return b"".join([self.first[head], *map(self.after.__getitem__, rest)])
        except TypeError:  # a run that can't be told apart
            return self.whole(text)


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file; files are opened once."""
    if path not in _OPEN:
        _OPEN[path] = Encoder(path)
    return _OPEN[path]
