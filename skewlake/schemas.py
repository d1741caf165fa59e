"""Declared schemas of all tables; nothing is inferred."""

QUOTES = """symbol string, strike double, expiry date, option_type string, snapshot_time timestamp, bid double, ask double,
last double, volume long, open_interest long, underlying_price double, iv_bid double, iv_ask double, iv_mid double,
delta double, gamma double, theta double, vega double, rho double, dte int, moneyness double, is_atm boolean,
collection_batch string, created_at timestamp"""
QUOTES_KEY = ["symbol", "strike", "expiry", "option_type", "snapshot_time"]

UNDERLYING_SNAPSHOTS = "symbol string, snapshot_time timestamp, price double, bid double, ask double, volume long, collection_batch string, created_at timestamp"
UNDERLYING_SNAPSHOTS_KEY = ["symbol", "snapshot_time"]

PROGRESS = """batch_id string, symbol string, snapshot_time timestamp, status string, num_contracts_processed int,
num_contracts_total int, error_message string, created_at timestamp, updated_at timestamp"""
PROGRESS_KEY = ["batch_id"]

TARGET_SNAPSHOTS = """symbol string, snapshot_time timestamp, expiry date, strike double, option_type string,
target_tenor_dte int, target_delta_abs double, dte int, delta_gap_abs double, bid double, ask double, last double,
volume long, open_interest long, underlying_price double, iv_bid double, iv_ask double, iv_mid double, delta double,
gamma double, theta double, vega double, rho double, collection_batch string"""
TARGET_SNAPSHOTS_KEY = ["symbol", "snapshot_time", "expiry", "strike", "option_type", "target_tenor_dte", "target_delta_abs"]

TARGET_PROGRESS = """batch_id string, symbol string, snapshot_time timestamp, status string, expected_targets int,
completed_targets int, missing_targets int, error_message string"""
TARGET_STATUS = """batch_id string, symbol string, snapshot_time timestamp, option_type string, target_tenor_dte int,
target_delta_abs double, status string, reason string, selected_expiry date, selected_strike double,
selected_delta double, delta_gap_abs double"""
TARGET_STATUS_KEY = ["batch_id", "symbol", "option_type", "target_tenor_dte", "target_delta_abs"]

OPTION_BARS = """symbol string, strike double, expiry date, option_type string, what_to_show string, bar_ts timestamp,
open double, high double, low double, close double, volume long, underlying_price double, collection_batch string"""
OPTION_BARS_KEY = ["symbol", "strike", "expiry", "option_type", "what_to_show", "bar_ts"]

UNDERLYING_BARS = "symbol string, trade_date date, open double, high double, low double, close double, volume long, collection_batch string"
UNDERLYING_BARS_KEY = ["symbol", "trade_date"]

CHECKPOINTS = """batch_id string, symbol string, trade_date date, expiry date, strike double, option_type string,
bar_size string, what_to_show string, use_rth boolean, status string, attempts int, retry_budget int,
backoff_until timestamp, last_error string, unavailable_reason string, probe_evidence string,
last_attempt_at timestamp, completed_at timestamp"""
CHECKPOINTS_KEY = ["batch_id", "symbol", "trade_date", "expiry", "strike", "option_type", "bar_size", "what_to_show", "use_rth"]

CHAINS = "symbol string, exchange string, trading_class string, multiplier string, strikes array<double>, expirations array<string>"
TICKS = "event_id long, ts timestamp, symbol string, last double, bid double, ask double, volume int"
