"""Past-only behavioural features.

Every history column uses only rows strictly before the current one:
expanding frames are ordered by (step, txn_id) and end one row before the
current row; RANGE (velocity) frames cover steps [step-h, step-1] and so
exclude the whole current step.

Plan shape.  `history` adds the columns of one key family to the growing row,
so nothing is joined back: rows are dealt by (type, step) once, while they are
narrow, by origin once (origin and pair families share that layout), and by
destination once. A row carries plain statistics; the features made of them
are added after the last exchange.

A plain `Window.partitionBy(key)` puts all rows of a key in one task, and one
receiver may hold a third of all rows.  Each family therefore counts rows per
key first (partial aggregation), pairs among the rows of hot origins only.  Without a key above `hot_key_rows` (at most
rows / hot_key_rows keys are) the plain window is the plan.  Otherwise all rows
take one branch, with a window keyed by (key, chunk): the chunk is empty for
cold keys, and the step for hot ones, so hot keys are dealt by step.

  L1  of the hot keys alone, one row per (key, step): bounded by the number of
      steps whatever the ids are.  A (key, step) group above `history_block`
      rows (B) is cut into ranges of txn_id of about B rows, by edges from a
      hash sample of its ids, so clustered ids cut as evenly as dense ones.
      B is raised to 1 / _MOST_EDGES of the rows in large groups where that is
      more, so that rows meet their edges by broadcast and are dealt once;
  L2  prefix sums and RANGE frames over L1 per key: the history before a chunk.
      The table is written once and joined to the rows from the left;
  L3  the history of a row is that of its chunk plus a window inside it.

Keys are compared as structs, so a NULL key is a key like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.config import DEFAULT, TXN_TYPES, RiskConfig
from riskframe.session import _SMALL_TABLE, materialized, small_table

HotKeys = tuple[DataFrame, int]
_UNB = Window.unboundedPreceding
_PER_EDGE = 64  # sampled ids per range of a large (key, step) group
_MOST_EDGES = _SMALL_TABLE // 2  # of all groups: edges are broadcast however many rows there are


def _dbl(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def history(rows: DataFrame, keys: list[str], cfg: RiskConfig = DEFAULT, *, source: DataFrame | None = None,
            split_all: bool = False, every_row: bool = False, prefix: str = "k", want_max: bool = False, want_prev: bool = False,
            prev_type: bool = False, flag_col: str | None = None, first_of: list[str] | None = None, hot: HotKeys | None = None,
            ranges: dict[str, tuple[int, int, str]] | None = None) -> DataFrame:
    """rows plus expanding past-only statistics per key: `{prefix}_n`, `_s` and, as asked, `_mx`, `_prev_step`,
    `_prev_type`, `_f` (sum of flag_col); `ranges` maps a column name to (lo, hi, "count" | "sum") over steps
    [step-lo, step-hi].

    `source` is a cheaper frame with the same transactions (and the columns
    read here) for the key counts and L1; where it lacks flag_col, the flag is
    1 on the first row by (step, txn_id) of each combination of `first_of`, the
    keys among them.  `hot` has the hot keys where they are known.  `split_all`
    takes every key for hot without counting (few keys, each with many rows);
    rows without a step then go, unless `every_row` keeps them.
    """
    opts = dict(prefix=prefix, want_max=want_max, want_prev=want_prev, prev_type=prev_type, flag_col=flag_col,
                ranges=ranges or {})
    own_flag = [flag_col] if flag_col and first_of is None else []
    source = rows if source is None else source
    if split_all:
        hot = None
    else:
        hot, n = hot or hot_keys(source, keys, cfg)
        if not n:
            return _plain(rows, keys, **opts)
        source = _of_hot(source, keys, hot)
    src = source.select("txn_id", "step", "amount", F.struct(*keys).alias("_key"), *(["txn_type"] if prev_type else []), *own_flag)
    flagged = None
    if first_of is not None:
        first = source.groupBy(*first_of).agg(F.min(F.struct("step", "txn_id")).alias("_first"))
        flagged = first.select("_first.*", F.struct(*keys).alias("_key"))
    block = _blocked(src, cfg)
    table = _prefixes(chunk_table(src, block, want_max=want_max, prev_type=prev_type, flag_col=flag_col, flagged=flagged),
                      **{k: v for k, v in opts.items() if k != "prefix"})
    if hot is not None:
        table = materialized(table, "prefixes")  # hot keys x (steps + rows / B) at most
    how = "left" if hot is not None or every_row else "inner"
    return _chunked(rows, keys, hot, block, table, how, **opts)


def hot_keys(source: DataFrame, keys: list[str], cfg: RiskConfig = DEFAULT) -> HotKeys:
    """The keys with more than hot_key_rows rows (column `_hot`, broadcast if few), and how many they are."""
    counts = source.groupBy(F.struct(*keys).alias("_hot")).agg(F.count(F.lit(1)).alias("_kn"))
    return small_table(materialized(counts.where(F.col("_kn") > cfg.hot_key_rows).select("_hot"), "hot-keys"))


def _of_hot(source: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    return source.join(hot, F.struct(*[source[k] for k in keys]) == hot["_hot"], "left_semi")


def past_only(rows: DataFrame, keys: list[str], cfg: RiskConfig = DEFAULT, **opts) -> DataFrame:
    """`history` without the input columns: txn_id and the statistics."""
    out = history(rows, keys, cfg, **opts)
    return out.select("txn_id", *[c for c in out.columns if c not in rows.columns])


def _plain(rows: DataFrame, keys: list[str], *, prefix, want_max, want_prev, prev_type, flag_col, ranges) -> DataFrame:
    """One window per key over rows: ROWS frames on (step, txn_id), RANGE frames on step."""
    w = Window.partitionBy(*keys).orderBy("step", "txn_id")
    ex = w.rowsBetween(_UNB, -1)
    out = [F.count(F.lit(1)).over(ex).alias(f"{prefix}_n"), F.sum("amount").over(ex).cast("decimal(38,2)").alias(f"{prefix}_s")]
    if want_max:
        out.append(F.max("amount").over(ex).alias(f"{prefix}_mx"))
    if want_prev:
        out.append(F.lag("step").over(w).alias(f"{prefix}_prev_step"))
    if prev_type:
        out.append(F.lag("txn_type").over(w).alias(f"{prefix}_prev_type"))
    if flag_col:
        out.append(F.coalesce(F.sum(flag_col).over(ex), F.lit(0)).cast("bigint").alias(f"{prefix}_f"))
    ws = Window.partitionBy(*keys).orderBy("step")
    for name, (lo, hi, measure) in ranges.items():
        frame = ws.rangeBetween(-lo, -hi)
        out.append((F.count(F.lit(1)).over(frame) if measure == "count"
                    else F.sum("amount").over(frame).cast("decimal(38,2)")).alias(name))
    return rows.select("*", *out)


def _blocked(src: DataFrame, cfg: RiskConfig):
    """A function that adds `_blk`, the range of txn_id of a row inside its (key, step) group, to frames with `_key`.

    Groups of up to history_block rows are one range.  The edges of larger ones
    are every 64th of a hash sample of their ids, about history_block rows apart, or more where edges would be too many."""
    counts = src.groupBy("_key", "step").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > cfg.history_block)
    big = materialized(counts.select(F.col("_key").alias("_bk"), F.col("step").alias("_bs"), "_n"), "large-groups")
    block = max(cfg.history_block, -(-(big.agg(F.sum("_n")).first()[0] or 0) // _MOST_EDGES))
    big, n = small_table(big.where(F.col("_n") > block).select("_bk", "_bs"))
    if not n:
        return lambda df: df.withColumn("_blk", F.lit(0).cast("long"))
    one_in = max(1, block // _PER_EDGE)
    sample = src.where(F.pmod(F.xxhash64("txn_id"), F.lit(one_in)) == 0)
    sample = sample.join(big, (sample["_key"] == F.col("_bk")) & (sample["step"] == F.col("_bs")))
    per_edge = max(1, block // one_in)
    ids = F.sort_array(F.collect_list("txn_id"))
    at = F.sequence(F.lit(per_edge), F.size("_ids"), F.lit(per_edge))
    edges = sample.groupBy("_bk", "_bs").agg(ids.alias("_ids")).where(F.size("_ids") >= per_edge).select(
        "_bk", "_bs", F.transform(at, lambda i: F.get("_ids", i - 1)).alias("_edges"))
    edges, _ = small_table(materialized(edges, "id-edges"), F.size("_edges"))

    def add(df: DataFrame) -> DataFrame:
        inside = F.size(F.filter("_edges", lambda e: e <= F.col("txn_id"))).cast("long")
        return df.join(edges, (df["_key"] == F.col("_bk")) & (df["step"] == F.col("_bs")), "left").withColumn(
            "_blk", F.when(F.col("_edges").isNull(), F.lit(0).cast("long")).otherwise(inside)).drop("_bk", "_bs", "_edges")

    return add


def chunk_table(src: DataFrame, block, *, want_max=False, prev_type=False, flag_col=None, flagged=None) -> DataFrame:
    """L1: one row per (key, step), or per txn_id range of a large (key, step) group."""
    aggs = [F.sum("c_one").cast("long").alias("c_n"), F.sum("amount").alias("c_s")]
    rows = src.withColumn("c_one", F.lit(1))
    if want_max:
        aggs.append(F.max("amount").alias("c_mx"))
    if prev_type:
        aggs.append(F.max_by("txn_type", "txn_id").alias("c_last_type"))
    if flag_col:
        if flagged is not None:  # marks come as rows of their own that count for nothing else
            marks = flagged.select("txn_id", "step", "_key", F.lit(0).alias("c_one"), F.lit(1).alias(flag_col))
            rows = rows.unionByName(marks, allowMissingColumns=True)
        aggs.append(F.sum(flag_col).alias("c_f"))
    return block(rows).groupBy("_key", "step", "_blk").agg(*aggs)


def _prefixes(l1: DataFrame, *, want_max, want_prev, prev_type, flag_col, ranges) -> DataFrame:
    """L2: (t_key, t_step, t_blk) with the history of the key before the chunk."""
    wk = Window.partitionBy("_key").orderBy("step", "_blk")
    ex = wk.rowsBetween(_UNB, -1)
    l2 = [F.coalesce(F.sum("c_n").over(ex), F.lit(0)).alias("p_n"), F.sum("c_s").over(ex).alias("p_s")]
    if want_max:
        l2.append(F.max("c_mx").over(ex).alias("p_mx"))
    if want_prev:
        l2.append(F.lag("step").over(wk).alias("p_prev_step"))
    if prev_type:
        l2.append(F.lag("c_last_type").over(wk).alias("p_prev_type"))
    if flag_col:
        l2.append(F.coalesce(F.sum("c_f").over(ex), F.lit(0)).alias("p_f"))
    ws = Window.partitionBy("_key").orderBy("step")
    for name, (lo, hi, measure) in ranges.items():
        frame = ws.rangeBetween(-lo, -hi)
        l2.append((F.coalesce(F.sum("c_n").over(frame), F.lit(0)) if measure == "count"
                   else F.sum("c_s").over(frame)).alias(f"p_{name}"))
    return l1.select(F.col("_key").alias("t_key"), F.col("step").alias("t_step"), F.col("_blk").alias("t_blk"), *l2)


def _chunked(rows: DataFrame, keys: list[str], hot: DataFrame | None, block, table: DataFrame, how: str, *, prefix, want_max,
             want_prev, prev_type, flag_col, ranges) -> DataFrame:
    """L3 for all rows: one window keyed by (key, chunk) on top of the chunk's prefix; hot None: every key is hot."""
    keyed = rows.withColumn("_key", F.struct(*keys))
    if hot is not None:
        keyed = keyed.join(hot, keyed["_key"] == F.col("_hot"), "left")
    is_hot = F.col("_hot").isNotNull() if hot is not None else F.lit(True)
    keyed = block(keyed)
    keyed = keyed.withColumns({"_cs": F.when(is_hot, F.col("step")), "_cb": F.when(is_hot, F.col("_blk"))})
    is_hot = F.col("_cb").isNotNull()  # from here on, so that rows are not dealt with a second copy of their key
    j = keyed.join(table, (keyed["_key"] == table["t_key"]) & (keyed["_cs"] == table["t_step"]) & (keyed["_cb"] == table["t_blk"]),
                   how)
    chunk = Window.partitionBy("_key", "_cs", "_cb")
    w = chunk.orderBy("step", "txn_id")
    ex = w.rowsBetween(_UNB, -1)
    first = F.row_number().over(w) == 1
    n = F.coalesce(F.col("p_n"), F.lit(0)) + F.count(F.lit(1)).over(ex)
    zero = F.lit(0).cast("decimal(18,2)")
    out = [n.alias(f"{prefix}_n"),
           F.when(n > 0, F.coalesce(F.col("p_s"), zero) + F.coalesce(F.sum("amount").over(ex), zero)).cast("decimal(38,2)")
           .alias(f"{prefix}_s")]
    if want_max:
        out.append(F.greatest(F.col("p_mx"), F.max("amount").over(ex)).alias(f"{prefix}_mx"))
    if want_prev:
        out.append(F.when(first, F.col("p_prev_step")).otherwise(F.lag("step").over(w)).alias(f"{prefix}_prev_step"))
    if prev_type:
        out.append(F.when(first, F.col("p_prev_type")).otherwise(F.lag("txn_type").over(w)).alias(f"{prefix}_prev_type"))
    if flag_col:
        out.append((F.coalesce(F.col("p_f"), F.lit(0)) + F.coalesce(F.sum(flag_col).over(ex), F.lit(0))).cast("bigint").alias(f"{prefix}_f"))
    by_step = chunk.orderBy("step")
    for name, (lo, hi, measure) in ranges.items():
        frame = by_step.rangeBetween(-lo, -hi)  # holds nothing inside one step of a hot key
        cold = F.count(F.lit(1)).over(frame) if measure == "count" else F.sum("amount").over(frame)
        value = F.col(f"p_{name}") if hot is None else F.when(is_hot, F.col(f"p_{name}")).otherwise(cold)
        out.append((value if measure == "count" else value.cast("decimal(38,2)")).alias(name))
    return j.select(*[keyed[c] for c in rows.columns], *out)


def _avg(s: str, n: str) -> Column:
    return _dbl(s) / F.when(F.col(n) > 0, _dbl(n))


def _ratio(num: Column, den: Column) -> Column:
    """P8 safe ratio: x / NULLIF(y, 0); never raises under ANSI mode."""
    return num / F.when(den != 0, den)


def base_expressions(cfg: RiskConfig = DEFAULT) -> list[Column]:
    """P1, P3, P5-P7 on the canonical columns (row-local)."""
    spd = cfg.steps_per_day
    kind = F.substring("name_dest", 1, 1)
    return [
        (F.floor((F.col("step") - 1) / spd) + 1).cast("int").alias("sim_day"),
        ((F.col("step") - 1) % spd).cast("int").alias("hour_of_day"),
        F.round(F.log10(_dbl(F.greatest(F.col("amount"), F.lit(0))) + F.lit(1.0)), 9).alias("log_amount"),
        F.when(F.col("amount") % 1000 == 0, 1).otherwise(0).alias("amount_is_round_1000"),
        kind.alias("dest_kind"), F.when(kind == "M", 1).otherwise(0).alias("dest_is_merchant"),
    ]


def _origin_stats(df: DataFrame, cfg: RiskConfig, source: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    out = history(df, ["name_orig"], cfg, source=source, hot=hot, prefix="o", want_max=True, want_prev=True, prev_type=True,
                  ranges={"o_v24": (24, 1, "count")})
    return out.withColumn("o_s", _dbl("o_s"))  # a third of a wide decimal's bytes


def _origin_columns(df: DataFrame) -> DataFrame:
    amt, avg, mx = _dbl("amount"), _avg("o_s", "o_n"), _dbl("o_mx")
    return df.select(
        *[c for c in df.columns if not c.startswith("o_")],
        F.col("o_n").alias("orig_prior_txn_count"), avg.alias("orig_prior_avg_amount"),
        mx.alias("orig_prior_max_amount"), F.coalesce(_dbl("o_s"), F.lit(0.0)).alias("orig_prior_total_amount"),
        F.when(F.col("o_n") > 0, 1).otherwise(0).alias("orig_has_history"),
        F.col("o_prev_type").alias("orig_prev_txn_type"), F.col("o_v24").alias("orig_txn_prev_24h"),
        (F.col("step") - F.col("o_prev_step")).alias("orig_steps_since_prev_txn"),
        _ratio(amt, avg).alias("orig_amount_to_prior_avg"), (amt - avg).alias("orig_amount_minus_prior_avg"),
        _ratio(amt, mx).alias("orig_amount_to_prior_max"))


def _pair_stats(df: DataFrame, cfg: RiskConfig, source: DataFrame, hot_origins: HotKeys | None = None) -> DataFrame:
    # a hot pair is a pair of a hot origin: where there is none, pairs (nearly as many as rows) are not counted
    hot, n = hot_origins or hot_keys(source, ["name_orig"], cfg)
    found = hot_keys(_of_hot(source, ["name_orig"], hot), ["name_orig", "name_dest"], cfg) if n else (hot, 0)
    out = history(df, ["name_orig", "name_dest"], cfg, source=source, hot=found, prefix="q")
    return out.withColumn("q_s", _dbl("q_s")).withColumn("is_first_contact", F.when(F.col("q_n") == 0, 1).otherwise(0))


def _pair_columns(df: DataFrame) -> DataFrame:
    return df.select(
        *[c for c in df.columns if not c.startswith("q_")], F.col("q_n").alias("pair_prior_txn_count"),
        F.col("is_first_contact").alias("pair_is_new"), F.coalesce("q_s", F.lit(0.0)).alias("pair_prior_total_amount"))


def _dest_stats(df: DataFrame, cfg: RiskConfig, source: DataFrame, fan_in: bool) -> DataFrame:
    rng = {f"d_v{h}": (h, 1, "count") for h in cfg.velocity_windows}
    rng["d_a24"] = (24, 1, "sum")
    rng["d_v1"] = (1, 1, "count")
    # the first-contact flag is on the growing row only; the split of a hot receiver finds it by aggregation
    return history(df, ["name_dest"], cfg, source=source, prefix="d", want_max=True, want_prev=True,
                   flag_col="is_first_contact" if fan_in else None, first_of=["name_orig", "name_dest"] if fan_in else None, ranges=rng)


def _dest_columns(df: DataFrame, cfg: RiskConfig, fan_in: bool) -> DataFrame:
    long_w = max(cfg.velocity_windows)
    v24, vlong = F.col("d_v24"), F.col(f"d_v{long_w}")
    avg = _avg("d_s", "d_n")
    return df.select(
        *[c for c in df.columns if not c.startswith("d_")],
        F.col("d_n").alias("dest_prior_txn_count"), avg.alias("dest_prior_avg_amount"),
        _dbl("d_mx").alias("dest_prior_max_amount"),
        F.coalesce(_dbl("d_s"), F.lit(0.0)).alias("dest_prior_total_amount"),
        F.when(F.col("d_n") > 0, 1).otherwise(0).alias("dest_has_history"),
        F.when(F.col("d_n") == 0, 1).otherwise(0).alias("dest_is_new"),
        *([F.col("d_f").alias("dest_prior_unique_senders")] if fan_in else []),
        *[F.col(f"d_v{h}").alias(f"dest_txn_prev_{h}h") for h in cfg.velocity_windows],
        F.coalesce(_dbl("d_a24"), F.lit(0.0)).alias("dest_amount_prev_24h"),
        F.col("d_v1").alias("dest_txn_prev_1h"),
        _ratio(_dbl(v24), _dbl(vlong) / F.lit(float(long_w) / cfg.steps_per_day)).alias(
            f"dest_velocity_ratio_24h_vs_{long_w}h"),
        (F.col("step") - F.col("d_prev_step")).alias("dest_steps_since_prev_txn"),
        _ratio(_dbl("amount"), avg).alias("dest_amount_to_prior_avg"))


def _type_stats(df: DataFrame, cfg: RiskConfig, source: DataFrame, every_row: bool = False) -> DataFrame:
    """Five keys would be five tasks as a plain window, so every type takes the split plan."""
    out = history(df, ["txn_type"], cfg, source=source, split_all=True, every_row=every_row, prefix="t")
    return out.select(*df.columns, _avg("t_s", "t_n").alias("type_prior_avg_amount"))


def _type_columns(df: DataFrame) -> DataFrame:
    return df.withColumn("amount_to_type_prior_avg", _ratio(_dbl("amount"), F.col("type_prior_avg_amount")))


def origin_history(txns: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """The input with expanding origin history, gap, ratios, previous type, 24h origin velocity."""
    return _origin_columns(_origin_stats(txns, cfg, txns))


def pair_history(txns: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """The input with expanding (origin, destination) history and first-contact flag."""
    return _pair_columns(_pair_stats(txns, cfg, txns))


def dest_history(txns: DataFrame, fan_in: bool = True, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """The input with destination history, RANGE velocity and, unless fan_in is off, fan-in.

    Only fan-in needs the pair family."""
    rows = pair_history(txns, cfg) if fan_in else txns
    return _dest_columns(_dest_stats(rows, cfg, txns, fan_in), cfg, fan_in)


def type_baseline(txns: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """The input with the expanding past-only average amount per transaction type and the ratio to it."""
    return _type_columns(_type_stats(txns, cfg, txns))


def one_hot_type(txn_type: str = "txn_type") -> list[Column]:
    """One int column per *fixed* type, so the schema never depends on data."""
    return [F.when(F.col(txn_type) == t, 1).otherwise(0).alias(f"type_{t}") for t in TXN_TYPES]


FEATURE_ORDER = [
    "txn_id", "step", "sim_day", "hour_of_day", "txn_type", "amount", "log_amount",
    "amount_is_round_1000", "name_orig", "name_dest", "dest_kind", "dest_is_merchant",
    "orig_prior_txn_count", "orig_prior_avg_amount", "orig_prior_max_amount", "orig_prior_total_amount",
    "orig_steps_since_prev_txn", "orig_has_history", "orig_amount_to_prior_avg",
    "orig_amount_minus_prior_avg", "orig_amount_to_prior_max", "orig_txn_prev_24h", "orig_prev_txn_type",
    "dest_prior_txn_count", "dest_prior_avg_amount", "dest_prior_max_amount", "dest_prior_total_amount",
    "dest_steps_since_prev_txn", "dest_has_history", "dest_is_new", "dest_amount_to_prior_avg",
    "dest_prior_unique_senders",
    "dest_txn_prev_24h", "dest_txn_prev_72h", "dest_txn_prev_168h", "dest_amount_prev_24h",
    "dest_txn_prev_1h", "dest_velocity_ratio_24h_vs_168h",
    "pair_prior_txn_count", "pair_is_new", "pair_prior_total_amount",
    "type_prior_avg_amount", "amount_to_type_prior_avg",
    "type_CASH_IN", "type_CASH_OUT", "type_DEBIT", "type_PAYMENT", "type_TRANSFER",
    "is_fraud",
]

# P15, fixed values: the model input list (never step, target, balances or the simulator flag)
MODEL_COLUMNS = [
    "amount", "log_amount", "amount_is_round_1000", "amount_to_type_prior_avg", "hour_of_day",
    "orig_prior_txn_count", "orig_prior_avg_amount", "orig_prior_max_amount", "orig_prior_total_amount",
    "orig_steps_since_prev_txn", "orig_has_history", "orig_amount_to_prior_avg",
    "orig_amount_minus_prior_avg", "orig_amount_to_prior_max", "orig_txn_prev_24h",
    "dest_prior_txn_count", "dest_prior_avg_amount", "dest_prior_max_amount", "dest_prior_total_amount",
    "dest_steps_since_prev_txn", "dest_has_history", "dest_amount_to_prior_avg", "dest_is_new",
    "dest_is_merchant", "dest_prior_unique_senders",
    "dest_txn_prev_24h", "dest_txn_prev_72h", "dest_txn_prev_168h", "dest_txn_prev_1h",
    "dest_velocity_ratio_24h_vs_168h",
    "pair_prior_txn_count", "pair_is_new", "pair_prior_total_amount",
    "type_CASH_IN", "type_CASH_OUT", "type_DEBIT", "type_PAYMENT", "type_TRANSFER",
]


NARROW = ["txn_id", "step", "txn_type", "amount", "name_orig", "name_dest", "is_fraud"]


def build_features(txns: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """The full feature table, one row per transaction, target last.

    One chain on the growing row: the type prefix on the input's columns, origin
    and pair windows on the layout by origin, then destination windows on the
    layout by destination. Rows without a step count in the accounts' histories
    and are left out of the table."""
    from riskframe.session import cached
    narrow = cached(txns.select(*NARROW))  # read by the key counts, the type prefix and the chain
    f = _type_stats(narrow, cfg, narrow, every_row=True)
    origins = hot_keys(narrow, ["name_orig"], cfg)
    f = _pair_stats(_origin_stats(f, cfg, narrow, origins), cfg, narrow, origins)
    f = _dest_stats(f, cfg, narrow, True).where(F.col("step").isNotNull())
    f = _dest_columns(_pair_columns(_origin_columns(_type_columns(f))), cfg, True)
    return f.select("*", *base_expressions(cfg), *one_hot_type()).select(*FEATURE_ORDER)


def fill_missing(features: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Undefined history -> 0.0 (paired with the *_has_history flags); numeric as DOUBLE."""
    columns = columns or MODEL_COLUMNS
    return features.select(
        *[c for c in features.columns if c not in columns],
        *[F.coalesce(_dbl(c), F.lit(0.0)).alias(c) for c in columns],
    )
