"""Tables as code: columns, keys, ordering and fixed-point scales.

``nullable=False`` means that the column must exist; values are not checked for nulls.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALE = 1_000_000_000
OPEN_END = 2**63 - 1

STRING, LONG, INT, DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
BOOLEAN, DATE, LONGS = T.BooleanType(), T.DateType(), T.ArrayType(T.LongType())


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    dtype: T.DataType
    nullable: bool = False
    scale: int | None = None


@dataclass(frozen=True)
class TableSpec:
    name: str
    kind: str  # event, dimension or control
    columns: tuple[ColumnSpec, ...]
    tie_break_keys: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    business_keys: tuple[str, ...] = ()

    def __post_init__(self):
        names = [c.name for c in self.columns]
        if len(set(names)) < len(names):
            raise ValueError(f"{self.name}: duplicate columns {sorted({n for n in names if names.count(n) > 1})}")
        unknown = {*self.tie_break_keys, *self.partition_by, *self.business_keys} - set(names)
        if unknown:
            raise ValueError(f"{self.name}: keys name unknown columns {sorted(unknown)}")

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable]

    @property
    def scaled(self) -> dict[str, int]:
        return {c.name: c.scale for c in self.columns if c.scale}

    def column(self, name: str) -> ColumnSpec:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(f"{self.name} has no column {name!r}; it has {self.names}")

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, c.dtype, True, {"scale": c.scale} if c.scale else {}) for c in self.columns]
        )

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.schema)


def required(name: str, dtype: T.DataType, scaled: bool = False) -> ColumnSpec:
    """A column that must be there; ``scaled`` ones are fixed-point."""
    return ColumnSpec(name, dtype, False, SCALE if scaled else None)


def optional(name: str, dtype: T.DataType, scaled: bool = False) -> ColumnSpec:
    return ColumnSpec(name, dtype, True, SCALE if scaled else None)


#: Columns of every event table.
_EVENT = (
    required("exchange", STRING),
    required("trading_date", DATE),
    required("symbol", STRING),
    required("symbol_id", LONG),
    required("ts_event_us", LONG),
    optional("ts_local_us", LONG),
    required("file_id", LONG),
    required("file_seq", LONG),
)
_ORDER = ("exchange", "symbol_id", "ts_event_us", "file_id", "file_seq")
_CN_ORDER = ("exchange", "symbol_id", "trading_date", "channel_id", "channel_seq", "file_id", "file_seq")
_PARTITION = ("exchange", "trading_date")


def _event(name: str, *columns: ColumnSpec, order: tuple[str, ...] = _ORDER) -> TableSpec:
    return TableSpec(name, "event", _EVENT + columns, order, _PARTITION)


#: The tables, column by column.
SPECS = {
    s.name: s
    for s in (
        _event(
            "trades",
            optional("trade_id", STRING),
            required("side", STRING),
            optional("is_buyer_maker", BOOLEAN),
            required("price", LONG, scaled=True),
            required("qty", LONG, scaled=True),
        ),
        _event(
            "quotes",
            required("bid_price", LONG, scaled=True),
            required("bid_qty", LONG, scaled=True),
            required("ask_price", LONG, scaled=True),
            required("ask_qty", LONG, scaled=True),
            optional("seq_num", LONG),
        ),
        _event(
            "orderbook_updates",
            optional("book_seq", LONG),
            required("side", STRING),
            required("price", LONG, scaled=True),
            required("qty", LONG, scaled=True),
            required("is_snapshot", BOOLEAN),
            order=("exchange", "symbol_id", "ts_event_us", "book_seq", "file_id", "file_seq"),
        ),
        _event(
            "derivative_ticker",
            required("mark_price", LONG, scaled=True),
            optional("index_price", LONG, scaled=True),
            optional("last_price", LONG, scaled=True),
            optional("open_interest", LONG, scaled=True),
            optional("funding_rate", DOUBLE),
            optional("predicted_funding_rate", DOUBLE),
            optional("funding_ts_us", LONG),
        ),
        _event(
            "liquidations",
            optional("liquidation_id", STRING),
            required("side", STRING),
            required("price", LONG, scaled=True),
            required("qty", LONG, scaled=True),
        ),
        _event(
            "options_chain",
            required("option_type", STRING),
            required("strike", LONG, scaled=True),
            required("expiration_ts_us", LONG),
            optional("open_interest", LONG, scaled=True),
            optional("last_price", LONG, scaled=True),
            optional("bid_price", LONG, scaled=True),
            optional("ask_price", LONG, scaled=True),
            optional("mark_price", LONG, scaled=True),
            optional("bid_qty", LONG, scaled=True),
            optional("ask_qty", LONG, scaled=True),
            optional("bid_iv", DOUBLE),
            optional("ask_iv", DOUBLE),
            optional("mark_iv", DOUBLE),
            optional("underlying_index", STRING),
            optional("underlying_price", LONG, scaled=True),
            optional("delta", DOUBLE),
            optional("gamma", DOUBLE),
            optional("vega", DOUBLE),
            optional("theta", DOUBLE),
            optional("rho", DOUBLE),
        ),
        _event(
            "cn_order_events",
            required("channel_id", INT),
            required("channel_seq", LONG),
            optional("channel_biz_seq", LONG),
            optional("symbol_order_seq", LONG),
            required("order_ref", LONG),
            required("event_kind", STRING),
            required("side", STRING),
            optional("order_type", STRING),
            required("price", LONG, scaled=True),
            required("qty", LONG, scaled=True),
            order=_CN_ORDER,
        ),
        _event(
            "cn_tick_events",
            required("channel_id", INT),
            required("channel_seq", LONG),
            optional("channel_biz_seq", LONG),
            optional("symbol_trade_seq", LONG),
            optional("bid_order_ref", LONG),
            optional("ask_order_ref", LONG),
            required("event_kind", STRING),
            optional("aggressor_side", STRING),
            required("price", LONG, scaled=True),
            required("qty", LONG, scaled=True),
            order=_CN_ORDER,
        ),
        _event(
            "cn_l2_snapshots",
            required("snapshot_seq", LONG),
            optional("image_status", STRING),
            optional("trading_phase_code", STRING),
            required("bid_price_levels", LONGS),
            required("bid_qty_levels", LONGS),
            required("ask_price_levels", LONGS),
            required("ask_qty_levels", LONGS),
            optional("bid_order_count_levels", LONGS),
            optional("ask_order_count_levels", LONGS),
            optional("pre_close_price", LONG, scaled=True),
            optional("open_price", LONG, scaled=True),
            optional("high_price", LONG, scaled=True),
            optional("low_price", LONG, scaled=True),
            optional("last_price", LONG, scaled=True),
            optional("volume", LONG),
            optional("amount", LONG),
            optional("num_trades", LONG),
            optional("total_bid_qty", LONG),
            optional("total_ask_qty", LONG),
            order=("exchange", "symbol_id", "ts_event_us", "snapshot_seq", "file_id", "file_seq"),
        ),
        TableSpec(
            "dim_symbol",
            "dimension",
            (
                required("symbol_id", LONG),
                required("exchange", STRING),
                required("exchange_symbol", STRING),
                required("canonical_symbol", STRING),
                required("market_type", STRING),
                required("base_asset", STRING),
                required("quote_asset", STRING),
                required("valid_from_ts_us", LONG),
                required("valid_until_ts_us", LONG),
                required("is_current", BOOLEAN),
                optional("tick_size", LONG, scaled=True),
                optional("lot_size", LONG, scaled=True),
                optional("contract_size", LONG, scaled=True),
                required("updated_at_ts_us", LONG),
            ),
            tie_break_keys=("exchange", "exchange_symbol", "valid_from_ts_us"),
            business_keys=("exchange", "exchange_symbol", "valid_from_ts_us"),
        ),
        TableSpec(
            "ingest_manifest",
            "control",
            (
                required("file_id", LONG),
                required("vendor", STRING),
                required("data_type", STRING),
                required("bronze_path", STRING),
                required("file_hash", STRING),
                required("status", STRING),
                required("rows_total", LONG),
                required("rows_written", LONG),
                required("rows_quarantined", LONG),
                optional("trading_date_min", DATE),
                optional("trading_date_max", DATE),
                required("created_at_ts_us", LONG),
                optional("processed_at_ts_us", LONG),
                optional("status_reason", STRING),
            ),
            tie_break_keys=("file_id",),
            business_keys=("vendor", "data_type", "bronze_path", "file_hash"),
        ),
        TableSpec(
            "validation_log",
            "control",
            (
                required("file_id", LONG),
                required("rule_name", STRING),
                required("severity", STRING),
                required("logged_at_ts_us", LONG),
                optional("file_seq", LONG),
                optional("field_name", STRING),
                optional("field_value", STRING),
                optional("ts_event_us", LONG),
                optional("symbol", STRING),
                optional("symbol_id", LONG),
                optional("message", STRING),
            ),
            tie_break_keys=("file_id", "logged_at_ts_us", "file_seq"),
        ),
    )
}
STATUSES = ("pending", "success", "failed", "quarantined")


def spec(name: str) -> TableSpec:
    try:
        return SPECS[name]
    except KeyError:
        raise KeyError(f"unknown table {name!r}; there are {sorted(SPECS)}") from None


def event_spec(name: str) -> TableSpec:
    found = spec(name)
    if found.kind != "event":
        raise ValueError(f"{name} is not an event table")
    return found


def normalize(df: DataFrame, table: str | TableSpec) -> DataFrame:
    """Columns of the table in its order: required ones must be there, missing nullable ones become nulls.

    Fixed-point columns must already be integers; a float there is an error, not a cast.
    """
    s = spec(table) if isinstance(table, str) else table
    have = dict(df.dtypes)
    if missing := [n for n in s.required if n not in have]:
        raise ValueError(f"{s.name}: required columns are missing: {missing}")
    if loose := [n for n in s.scaled if n in have and have[n] not in ("bigint", "int", "smallint", "tinyint", "void")]:
        raise ValueError(f"{s.name}: fixed-point columns must be integers: {loose}")
    return df.select(
        *((F.col(c.name) if c.name in have else F.lit(None)).cast(c.dtype).alias(c.name) for c in s.columns)
    )


def validate_schema(df: DataFrame, table: str | TableSpec) -> None:
    """Raises unless ``df`` has just the table's columns with just its types."""
    s = spec(table) if isinstance(table, str) else table
    have = {f.name: f.dataType for f in df.schema}
    faults = {
        "missing": [n for n in s.names if n not in have],
        "unexpected": [n for n in have if n not in s.names],
        "types": [c.name for c in s.columns if c.name in have and have[c.name].simpleString() != c.dtype.simpleString()],
    }
    if any(faults.values()):
        raise ValueError(f"{s.name}: " + ", ".join(f"{k}: {v}" for k, v in faults.items() if v))
