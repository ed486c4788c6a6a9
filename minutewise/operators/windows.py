"""Forecast dataset: group metadata, vocabularies, encodings, normalisation, window index,
window materialisation.

A forecast window is identified by its *origin* row (the last history row) inside a group's
minute-ordered series: history = rows origin−59..origin, horizon = rows origin+1..origin+10.
The index is lazy (one row per window, no arrays); arrays are built only where asked: for all
windows as slices of blocked series (one array a block of rows, with a halo for the windows at its
edges), or for a selected subset by exploding each selected window into its 70 (group, minute) keys
and equi-joining — never by pairing windows with rows inside a group. A sample of window numbers is
drawn and located without any window being built (``sample_numbers``, ``locate_windows``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from minutewise.operators.ordering import global_rank, running_total
from minutewise.schema import (CATEGORY_CODES, HISTORY, HORIZON, KEY, PAST_VALUE_FEATURES, STABILITY_CODES,
                               TIME_FEATURES, V1_FEATURES)


def group_windows_meta(features: DataFrame, history: int = HISTORY, horizon: int = HORIZON) -> DataFrame:
    """Per group row_count, category, stability; groups shorter than history+horizon dropped.

    Metadata is constant per group, so ``max`` is a deterministic any-value.
    """
    g = features.groupBy(*KEY).agg(F.count(F.lit(1)).alias("row_count"),
                                   F.max("category").alias("category"),
                                   F.max("stability").alias("stability"))
    return g.where(F.col("row_count") >= history + horizon)


def group_subset(groups: DataFrame, n: int) -> DataFrame:
    """Deterministic subset of n groups ordered by md5('region::cluster::func')."""
    h = F.md5(F.concat_ws("::", *KEY))
    chosen = groups.select(*KEY).orderBy(h, *KEY).limit(n)
    return groups.join(chosen, [groups[k].eqNullSafe(chosen[k]) for k in KEY], "left_semi")


def vocabulary(df: DataFrame, value: Column | str, name: str = "value") -> DataFrame:
    """D3: 0-based id of each distinct value in sorted order (distributed exact rank)."""
    v = value if isinstance(value, Column) else F.col(value)
    distinct = df.select(v.alias(name)).distinct()
    return global_rank(distinct, [F.col(name)], "id").select(name, (F.col("id") - 1).alias("id"))


def function_key() -> Column:
    return F.concat_ws("::", *KEY)


def _passed_codes(df: DataFrame, col: str, encoded: Column) -> Column:
    """Integer classes (as the raw-trace path emits) are codes already; NULL → 0."""
    if isinstance(df.schema[col].dataType, T.NumericType):
        return F.coalesce(F.col(col).cast("int"), F.lit(0))
    return encoded


def encoded_classes(df: DataFrame, mode: str = "v2") -> dict[str, Column]:
    """D4/D4b for a table: ``category_id`` and ``stability_id`` by the type of its columns."""
    return {"category_id": _passed_codes(df, "category", encode_category(mode=mode)),
            "stability_id": _passed_codes(df, "stability", encode_stability(mode=mode))}


def _code_map(c: Column, codes: dict[str, int]) -> Column:
    expr = None
    for k, v in codes.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr


def encode_category(col: str = "category", mode: str = "v2") -> Column:
    """Rare 0 / Normal 1 / Hot 2; unknown text → Rare (v2) or 0 (v1, D4b); NULL → 0."""
    c = F.col(col)
    mapped = _code_map(c, CATEGORY_CODES)
    return F.when(c.isNull(), 0).otherwise(F.coalesce(mapped, F.lit(CATEGORY_CODES["Rare"] if mode == "v2" else 0)))


def encode_stability(col: str = "stability", mode: str = "v2") -> Column:
    """Stable 0 / Noisy 1; unknown text → Noisy (v2) or 0 = Stable (v1, D4b); NULL → 0."""
    c = F.col(col)
    mapped = _code_map(c, STABILITY_CODES)
    return F.when(c.isNull(), 0).otherwise(F.coalesce(mapped, F.lit(STABILITY_CODES["Noisy"] if mode == "v2" else 0)))


def train_rows(features: DataFrame, history: int = HISTORY, horizon: int = HORIZON) -> DataFrame:
    """Rows that training windows (D13) read: positions below train_end + history + horizon − 1."""
    from minutewise.operators.splits import split_bounds
    pos = window_positions(features, history, horizon)
    n_windows = F.col("row_count") - (history + horizon) + 1
    train_end, _ = split_bounds(n_windows)
    keep = (n_windows >= 1) & (F.col("pos") < train_end + history + horizon - 1)
    return pos.where(keep).drop("pos", "row_count", "active", "is_origin", "start")


def feature_statistics(features: DataFrame, cols: list[str] = PAST_VALUE_FEATURES, fit_on: str = "all") -> DataFrame:
    """Mean and population std of COALESCE(x, 0); std 0 (or NULL) → 1.

    ``fit_on='all'`` uses the whole table, as the reference does (test minutes leak into the
    scaling); ``'train'`` uses only the rows read by training windows."""
    if fit_on == "train":
        features = train_rows(features)
    elif fit_on != "all":
        raise ValueError("fit_on must be 'all' or 'train'")
    aggs = []
    for c in cols:
        x = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        aggs += [F.avg(x).alias(f"{c}_mean"), F.coalesce(F.stddev_pop(x), F.lit(0.0)).alias(f"_{c}_std")]
    stats = features.agg(*aggs)
    return stats.select(*[F.col(f"{c}_mean") for c in cols],
                        *[F.when(F.col(f"_{c}_std") == 0, 1.0).otherwise(F.col(f"_{c}_std")).alias(f"{c}_std")
                          for c in cols])


def normalise(features: DataFrame, stats: DataFrame, cols: list[str] = PAST_VALUE_FEATURES) -> DataFrame:
    """D6 + D7: NULL → 0, z-score with the one-row statistics; raw target kept as ``raw_target``."""
    s = stats.first()  # one row of 2 × len(cols) doubles
    out = features.withColumn("raw_target", F.coalesce(F.col("requests").cast("double"), F.lit(0.0)))
    z = {c: ((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.lit(s[f"{c}_mean"])) / F.lit(s[f"{c}_std"]))
         for c in cols}
    t = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in TIME_FEATURES if c in features.columns}
    return out.withColumns({**z, **t})


def window_positions(features: DataFrame, history: int = HISTORY, horizon: int = HORIZON) -> DataFrame:
    """Per row: ``pos`` (0-based in the group series), group ``row_count``, and whether the row
    is a window origin; plus D14 ``active`` (any demand in the next ``horizon`` rows)."""
    w = Window.partitionBy(*KEY).orderBy("minute")
    whole = Window.partitionBy(*KEY)
    ahead = w.rowsBetween(1, horizon)
    out = features.select(
        "*",
        (F.row_number().over(w) - 1).alias("pos"),
        F.count(F.lit(1)).over(whole).alias("row_count"),
        (F.max("requests").over(ahead) > 0).alias("active"),
    )
    is_origin = (F.col("pos") >= history - 1) & (F.col("pos") <= F.col("row_count") - horizon - 1)
    return out.withColumn("is_origin", is_origin).withColumn("start", F.col("pos") - (history - 1))


def window_index(groups: DataFrame, history: int = HISTORY, horizon: int = HORIZON) -> DataFrame:
    """Per group (sorted by key) its 0-based ``group_id``, window count ``n_windows`` and
    exclusive global ``offset`` (window index = offset + start)."""
    g = groups.withColumn("n_windows", (F.col("row_count") - (history + horizon) + 1).cast("long"))
    g = g.where(F.col("n_windows") >= 1)
    run = running_total(g, [F.col(k) for k in KEY], "n_windows", "_cum", "_rank")
    return run.select(*groups.columns, "n_windows", (F.col("_rank") - 1).alias("group_id"),
                      (F.col("_cum") - F.col("n_windows")).alias("offset"))


def calendar_groups(sparse: DataFrame) -> DataFrame:
    """Groups with the ``row_count`` of their dense series, from the sparse minutes: every group has a row for each
    minute of the calendar."""
    bounds = sparse.select((F.max("minute") - F.min("minute") + 1).cast("long")).scalar()
    return sparse.select(*KEY).distinct().select(*KEY, bounds.alias("row_count"))


#: Window numbers of a bucket in ``locate_windows``.
NUMBERS_A_BUCKET = 1 << 16


def locate_windows(numbers: DataFrame, index: DataFrame, number: str = "window_index", bucket: int = NUMBERS_A_BUCKET) -> DataFrame:
    """D8 lookup: the group and start of given window numbers (KEY, group_id, ``number``, start); numbers that no
    window has are left out.

    The groups' intervals of numbers lie side by side, so this is an as-of join: numbers and interval starts are dealt
    into buckets of ``bucket`` numbers (an interval to each bucket that it reaches), and within a bucket the last
    interval start at or before a number is carried forward. No number is compared with the intervals of a bucket, and
    no task holds more than a bucket's intervals and numbers, however unequal the groups are.
    """
    held = F.struct(*KEY, "group_id", "offset", "n_windows")
    starts = index.select(
        F.explode(F.sequence(F.floor(F.col("offset") / bucket), F.floor((F.col("offset") + F.col("n_windows") - 1) / bucket))).alias("b"),
        F.col("offset").alias("at"), held.alias("held"))
    starts = starts.select("b", F.greatest(F.col("at"), F.col("b") * bucket).alias("at"), F.lit(False).alias("asked"), "held")
    asked = numbers.select(F.floor(F.col(number) / bucket).alias("b"), F.col(number).cast("long").alias("at"), F.lit(True).alias("asked"),
                           F.lit(None).cast(starts.schema["held"].dataType).alias("held"))
    w = Window.partitionBy("b").orderBy("at", "asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (starts.unionByName(asked).withColumn("held", F.last("held", ignorenulls=True).over(w)).where("asked")
             .select("held.*", F.col("at").alias(number)))
    start = F.col(number) - F.col("offset")
    return found.where((start >= 0) & (start < F.col("n_windows"))).select(*KEY, "group_id", number, start.alias("start"))


def windows(features: DataFrame, history: int = HISTORY, horizon: int = HORIZON, groups: DataFrame | None = None) -> DataFrame:
    """The lazy window table: one row per window with key, start, origin minute, global index,
    group id, active flag. No arrays.

    Only the key, ``minute`` and ``requests`` are read: the dense calendar will do. ``groups`` (KEY, row_count) may be
    given where the lengths of the series are known (``calendar_groups``), which saves counting them."""
    features = features.select(*KEY, "minute", "requests")
    rows = window_positions(features, history, horizon).where("is_origin")
    if groups is None:
        groups = features.groupBy(*KEY).agg(F.count(F.lit(1)).alias("row_count"))
    idx = window_index(groups.where(F.col("row_count") >= history + horizon), history, horizon)
    idx = idx.select(*KEY, "group_id", "offset", "n_windows")  # AQE picks the join from its size in bytes
    j = rows.join(idx, [rows[k].eqNullSafe(idx[k]) for k in KEY]).drop(*[idx[k] for k in KEY])
    return j.select(*KEY, "group_id", F.col("minute").alias("origin_minute"), "start", "n_windows",
                    (F.col("offset") + F.col("start")).alias("window_index"), "active")


#: Rows of a group whose windows share one block.
BLOCK_ROWS = 256


def series_blocks(normalised: DataFrame, features: list[str] = PAST_VALUE_FEATURES, time_features: list[str] = TIME_FEATURES,
                  history: int = HISTORY, horizon: int = HORIZON, carry: list[str] | None = None,
                  block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Each group's series in blocks: (KEY, block, rows), where ``rows`` holds in order the rows that the windows with
    their origin in the block read: its own ``block_rows`` and a halo of history − 1 before and horizon after them.

    A row is in 1 + 69/256 blocks on average instead of in 70 windows. A series that is partitioned by group, as the
    dense calendar and tables stored from it are, is not exchanged again.
    """
    w = Window.partitionBy(*KEY).orderBy("minute")
    rows = normalised.select(
        *KEY, "minute", *(carry or []), (F.row_number().over(w) - 1).alias("pos"),
        F.array(*[F.col(c).cast("float") for c in features]).alias("x"),
        F.array(*[F.col(c).cast("float") for c in time_features]).alias("t"),
        F.log1p(F.col("raw_target")).cast("float").alias("y"))
    first = F.floor(F.greatest(F.col("pos") - horizon, F.lit(0)) / block_rows)
    last = F.floor((F.col("pos") + history - 1) / block_rows)
    dealt = rows.withColumn("block", F.explode(F.sequence(first, last)))
    packed = F.sort_array(F.collect_list(F.struct("pos", "minute", *(carry or []), "x", "t", "y")))
    return dealt.groupBy(*KEY, "block").agg(packed.alias("rows"))


def block_windows(blocks: DataFrame, history: int = HISTORY, horizon: int = HORIZON, carry: list[str] | None = None,
                  whole_only: bool = True, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The windows of blocked series, one row per origin, as slices of the block's arrays."""
    cols = blocks.select(*KEY, "block", F.col("rows.pos").alias("pos"), F.col("rows.minute").alias("m"), F.col("rows.x").alias("x"),
                         F.col("rows.t").alias("t"), F.col("rows.y").alias("y"),
                         *[F.col(f"rows.{c}").alias(f"all_{c}") for c in carry or []])
    n = F.size("pos")
    lo = F.greatest(F.col("block") * block_rows, F.col("pos")[0] + (history - 1 if whole_only else 0))
    hi = F.least((F.col("block") + 1) * block_rows - 1, F.col("pos")[n - 1] - (horizon if whole_only else 0))
    here = cols.withColumn("n", n).withColumn("i", F.explode(F.when(lo <= hi, F.sequence(lo, hi)))) \
               .withColumn("i", (F.col("i") - F.col("pos")[0]).cast("int"))  # the origin's place in the arrays
    i = F.col("i")
    from_ = F.greatest(i - (history - 1), F.lit(0))
    past = lambda c: F.slice(c, from_ + 1, i - from_ + 1)
    ahead = lambda c: F.slice(c, i + 2, F.least(F.lit(horizon), F.col("n") - 1 - i))
    return here.select(*KEY, F.get("m", i).alias("minute"), *[F.get(f"all_{c}", i).alias(c) for c in carry or []],
                       past("x").alias("past_values"), past("t").alias("past_time"), ahead("t").alias("future_time"),
                       past("y").alias("past_target"), ahead("y").alias("target"))


def window_arrays(normalised: DataFrame, features: list[str] = PAST_VALUE_FEATURES,
                  time_features: list[str] = TIME_FEATURES, history: int = HISTORY,
                  horizon: int = HORIZON, carry: list[str] | None = None, whole_only: bool = True,
                  block_rows: int = BLOCK_ROWS) -> DataFrame:
    """D9 (all windows): arrays per origin row, float32, as slices of blocked series.

    past_values [history][len(features)], past_time [history][4], future_time [horizon][4],
    past_target = log1p(raw) over history, target = log1p(raw) over the horizon (D12).
    ``whole_only=False`` keeps the rows whose frames are cut by the group's ends.
    """
    blocks = series_blocks(normalised, features, time_features, history, horizon, carry, block_rows)
    return block_windows(blocks, history, horizon, carry, whole_only, block_rows)


def select_window_arrays(normalised: DataFrame, chosen: DataFrame, cols: list[str] = PAST_VALUE_FEATURES,
                         history: int = HISTORY, horizon: int = HORIZON) -> DataFrame:
    """D9 (selected windows): explode each chosen (K, origin_minute) into its history+horizon
    minutes, equi-join on (K, minute), regroup by window (bounded: history+horizon rows each).

    Relies on the dense calendar (consecutive minutes within a group)."""
    keys = chosen.select(*KEY, "origin_minute", "window_index").select(
        "*", F.posexplode(F.sequence(F.col("origin_minute") - (history - 1),
                                     F.col("origin_minute") + horizon)).alias("slot", "minute"))
    vec = F.array(*[F.col(c).cast("float") for c in cols])
    j = keys.join(normalised.select(*KEY, "minute", vec.alias("vec"),
                                    F.log1p(F.col("raw_target")).cast("float").alias("logt")), [*KEY, "minute"])
    g = j.groupBy(*KEY, "origin_minute", "window_index").agg(
        F.array_sort(F.collect_list(F.struct("slot", "vec", "logt"))).alias("_s"))
    return g.select(*KEY, "origin_minute", "window_index",
                    F.transform(F.slice("_s", 1, history), lambda s: s["vec"]).alias("past_values"),
                    F.transform(F.slice("_s", 1, history), lambda s: s["logt"]).alias("past_target"),
                    F.transform(F.slice("_s", history + 1, horizon), lambda s: s["logt"]).alias("target"))


def v1_samples(features: DataFrame, cols: list[str] = V1_FEATURES, history: int = HISTORY,
               horizon: int = HORIZON) -> DataFrame:
    """v1 samples — x = the 30 raw features (NULL → 0, float32) over the history,
    y = log1p(requests) over the horizon, v1 category/stability codes (unmapped → 0)."""
    filled = features.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols})
    filled = filled.withColumns({
        "raw_target": F.coalesce(F.col("requests").cast("double"), F.lit(0.0)),
        **encoded_classes(features, mode="v1"),
    })
    a = window_arrays(filled, cols, time_features=[], history=history, horizon=horizon,
                      carry=["category_id", "stability_id"])
    return a.select(*KEY, "minute", F.col("past_values").alias("x"), F.col("target").alias("y"),
                    "category_id", "stability_id")


def v1_adapter(arrays: DataFrame) -> DataFrame:
    """v1 sample adapter — past time = last four past-value columns, future time = the last
    past time row repeated (stale)."""
    src = "past_values" if "past_values" in arrays.columns else "x"
    past_time = F.transform(src, lambda r: F.slice(r, -4, 4))
    return arrays.withColumn("past_time", past_time).withColumn(
        "future_time", F.array_repeat(F.element_at(past_time, -1), HORIZON))


def group_rows(features: DataFrame, region: str, cluster: str, func: str) -> DataFrame:
    """One group's rows in minute order. On a stored feature table (partitioned by region) the filter prunes
    partitions and reaches the scan; on a computed one the whole table is built first."""
    return features.where((F.col("region") == region) & (F.col("clusterName") == cluster)
                          & (F.col("funcName") == func)).orderBy("minute")
