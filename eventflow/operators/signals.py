"""Market and social alert rules over time windows.

A price frame of one horizon spans at most two horizon-wide buckets: the end of one and the start
of the next. Running statistics are kept per (symbol, bucket) and merged, so each row costs a
constant amount of work however many prices its frame holds. A symbol with a large share of the data
is spread over its buckets, and a bucket above the block limit is cut further (see `ordered`). Equal
(symbol, time, price) rows are collapsed to a count first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from eventflow.operators.ordered import next_known, running_state

MARKET_DROP_PERCENT = 3.0
MARKET_SPIKE_PERCENT = 5.0
TRENDING_POSTS = 100
SENTIMENT_DELTA = 0.3


def seconds(interval: str) -> int:
    """Length of an interval such as '1 hour', '15 minutes' or '1 day' in seconds."""
    amount, unit = interval.split()
    units = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    return int(amount) * units[unit.rstrip("s")]


# --- prices ---------------------------------------------------------------------------------

def quotes(prices: DataFrame) -> DataFrame:
    """Distinct (symbol, ts, price) with the number of copies."""
    return prices.groupBy("symbol", "ts", "price").agg(F.count(F.lit(1)).alias("copies"))


def price_change(prices: DataFrame, horizon: str = "1 hour") -> DataFrame:
    """Percent change of each quote against the earliest price in its trailing horizon (the lowest
    one where several share that time). A zero base price gives null."""
    q = quotes(prices)
    span = F.expr(f"INTERVAL {horizon}")
    # Each quote as itself and, one horizon earlier, as the question which quote comes first.
    row = F.struct(F.col("ts").alias("at"), F.lit(1).alias("kind"))
    probe = F.struct((F.col("ts") - span).alias("at"), F.lit(0).alias("kind"))
    both = q.select("symbol", "price", "ts", "copies", F.inline(F.array(row, probe)))
    keys, order = ["symbol"], ["at", "kind", "price", "ts"]
    found = next_known(
        both, keys, order, F.when(F.col("kind") == 1, F.col("price")), "base_price",
        seconds(horizon),
    )
    change = F.try_divide(F.col("price") - F.col("base_price"), F.col("base_price")) * 100.0
    return found.filter("kind = 0").select(
        "symbol", "ts", "price", "copies", "base_price", change.alias("change_percent")
    )


def price_alerts(
    changes: DataFrame, drop: float = MARKET_DROP_PERCENT, spike: float = MARKET_SPIKE_PERCENT
) -> DataFrame:
    """Quotes that fell by more than `drop` or rose by more than `spike` percent (both strict)."""
    change = F.col("change_percent")
    kind = F.when(change < -drop, "PRICE_DROP").when(change > spike, "PRICE_SPIKE")
    return changes.withColumn("alert_type", kind).filter("alert_type IS NOT NULL")


def _merge_spread(a: Column, b: Column) -> Column:
    """Count, mean and sum of squared deviations of two samples taken together."""
    n = a["n"] + b["n"]
    gap = b["mean"] - a["mean"]
    return F.struct(
        n.alias("n"), (a["mean"] + gap * b["n"] / n).alias("mean"),
        (a["m2"] + b["m2"] + gap * gap * a["n"] * b["n"] / n).alias("m2"),
    )


def _add_spread(name: str):
    """Running count, mean and squared deviations of the ticks of a window, summed around the first
    tick of the window and not around zero, which would lose small deviations of large prices."""

    def add(ticks: DataFrame, window: WindowSpec) -> DataFrame:
        off = F.col("mean") - F.col("__c")
        centred = ticks.withColumn("__c", F.first("mean").over(window)).withColumns({
            "__d1": F.col("n") * off, "__d2": F.col("n") * off * off + F.col("m2"),
        })
        n, s1, s2 = (F.sum(c).over(window) for c in ("n", "__d1", "__d2"))
        spread = F.struct(
            n.alias("n"), (F.col("__c") + s1 / n).alias("mean"), (s2 - s1 * s1 / n).alias("m2")
        )
        return centred.withColumn(name, spread).drop("__c", "__d1", "__d2")

    return add


def volatility(
    prices: DataFrame, threshold: float | None = None, horizon: str = "1 hour"
) -> DataFrame:
    """Sample standard deviation over the trailing horizon, per (symbol, time); null for a single
    price. With a threshold only the rows above it are kept."""
    width = seconds(horizon) * 1_000_000
    keys, order = ["symbol", "bucket"], ["at"]
    ticks = (
        prices.filter(F.col("price").isNotNull())
        .groupBy("symbol", F.unix_micros("ts").alias("at"))
        .agg(
            F.count("price").alias("n"), F.avg("price").alias("mean"),
            (F.var_pop("price") * F.count("price")).alias("m2"), F.max("price").alias("last_price"),
        )
        .withColumn("bucket", F.floor(F.col("at") / F.lit(width)))
    )
    # a symbol is spread over its buckets already, with one row per distinct time
    head = running_state(ticks, keys, order, "head", _add_spread("head"))
    both = running_state(head, keys, order, "tail", _add_spread("tail"), reverse=True)

    # Each tick as itself and, one horizon earlier in the bucket before, as the question which tick
    # its frame starts with.
    tick = F.struct("bucket", F.col("at").alias("pos"), F.lit(1).alias("kind"))
    start = F.struct(
        (F.col("bucket") - 1).alias("bucket"), (F.col("at") - width).alias("pos"), F.lit(0).alias("kind")
    )
    asked = both.select(
        "symbol", "at", "last_price", "head", "tail", F.inline(F.array(tick, start))
    )
    framed = next_known(
        asked, keys, ["pos", "kind"], F.when(F.col("kind") == 1, F.col("tail")), "before", None
    ).filter("kind = 0")
    whole = F.when(F.col("before").isNull(), F.col("head")).otherwise(
        _merge_spread(F.col("before"), F.col("head"))
    )
    spread = framed.withColumn("__f", whole)
    n, m2 = F.col("__f.n"), F.greatest(F.col("__f.m2"), F.lit(0.0))
    out = spread.select(
        "symbol", F.timestamp_micros("at").alias("ts"), F.col("last_price").alias("price"),
        n.alias("prices"), F.when(n > 1, F.sqrt(m2 / (n - 1))).alias("volatility"),
    )
    return out if threshold is None else out.filter(F.col("volatility") > threshold)


def describe_price_alert(alerts: DataFrame, horizon: str = "1 hour") -> DataFrame:
    """Columns of a market alert event."""
    verb = F.when(F.col("alert_type") == "PRICE_DROP", "dropped").otherwise("surged")
    percent = F.format_string("%.1f", F.abs("change_percent"))
    return alerts.withColumns({
        "current_price": F.col("price"),
        "description": F.concat("symbol", F.lit(" "), verb, F.lit(" "), percent, F.lit(f"% in {horizon}")),
        "alert_key": F.concat_ws(":", "symbol", F.unix_micros("ts").cast("string"), F.col("price").cast("string")),
        "time": F.col("ts"),
    })


# --- posts ----------------------------------------------------------------------------------

def topic_counts(posts: DataFrame, width: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """Posts per topic over a sliding window. Also runs on a stream (watermark `ts` first).

    Where the windows are whole numbers of slides, a batch first counts per slide-wide slot, so that
    slots and not posts are spread over the windows. A stream keeps the single aggregation.
    """
    per_window = lambda df, time, posts: _window_bounds(
        df.groupBy("topic", F.window(time, width, slide)).agg(posts.alias("posts"))
    )
    if posts.isStreaming or seconds(width) % seconds(slide):
        return per_window(posts, "ts", F.count(F.lit(1)))
    slots = posts.groupBy("topic", F.window("ts", slide).start.alias("slot")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_window(slots, "slot", F.sum("n"))


def _window_bounds(df: DataFrame) -> DataFrame:
    return df.select(
        "topic", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "posts"
    )


def trending(counts: DataFrame, threshold: int = TRENDING_POSTS) -> DataFrame:
    return counts.filter(F.col("posts") > threshold)


def keyword_match(posts: DataFrame, keywords: Sequence[str], text: str = "text") -> DataFrame:
    """One row per post and configured keyword its whole text contains, ignoring case.

    The keywords are a configuration list: they become literals of one projection, no join."""
    lower = F.lower(text)
    hits = F.array_compact(F.array(*[F.when(lower.contains(k.lower()), F.lit(k)) for k in keywords]))
    return posts.withColumn("keyword", F.explode(hits))


def sentiment(posts: DataFrame, lexicon: dict[str, float], text: str = "text") -> DataFrame:
    """Sum of the lexicon weights of a post's words, and its sign as a label.

    Words are runs of letters, so punctuation and line breaks hide none. Each is looked up once in a
    literal map, inside the row: no shuffle. Whole-number weights give a BIGINT, others a DOUBLE.
    """
    kind = "bigint" if all(float(w).is_integer() for w in lexicon.values()) else "double"
    words = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}]+")
    weights = F.create_map(*[F.lit(x) if i % 2 == 0 else F.lit(x).cast(kind) for pair in lexicon.items() for i, x in enumerate(pair)])
    score = F.aggregate(words, F.lit(0).cast(kind), lambda sum_, w: sum_ + F.coalesce(F.element_at(weights, w), F.lit(0).cast(kind)))
    return posts.withColumn("score", score).withColumn("sentiment", sentiment_label(F.col("score")))


def sentiment_label(score: Column) -> Column:
    return F.when(score > 0, "POSITIVE").when(score < 0, "NEGATIVE").otherwise("NEUTRAL")


def topic_sentiment(scored: DataFrame, topic: str = "topic") -> DataFrame:
    return scored.groupBy(topic).agg(
        F.count(F.lit(1)).alias("posts"), F.avg("score").alias("mean_score"),
    ).withColumn("sentiment", sentiment_label(F.col("mean_score")))


def window_means(scored: DataFrame, width: str) -> DataFrame:
    """Posts and mean score per topic and window. A stream needs its watermark on `ts`."""
    means = scored.groupBy("topic", F.window("ts", width)).agg(
        F.count(F.lit(1)).alias("posts"), F.avg("score").alias("mean_score")
    )
    return means.select("topic", F.col("window.start").alias("window_start"), "posts", "mean_score")


def sentiment_spike(scored: DataFrame, width: str = "5 minutes", delta: float = SENTIMENT_DELTA) -> DataFrame:
    """Windows whose mean score moved by more than `delta` from the topic's previous non-empty
    window. The ordered step sees one row per topic and window."""
    means = window_means(scored, width)
    before = F.lag("mean_score").over(Window.partitionBy("topic").orderBy("window_start"))
    return means.withColumn("previous_mean", before).filter(
        F.abs(F.col("mean_score") - F.col("previous_mean")) > delta
    )


def describe_trend(trends: DataFrame, alert_type: str) -> DataFrame:
    """Columns of a social trend event, from rows with topic, window_start, posts and sentiment."""
    return trends.withColumns({
        "alert_type": F.lit(alert_type),
        "post_count": F.col("posts").cast("int"),
        "description": F.concat(
            F.lit(f"{alert_type} on '"), F.col("topic"), F.lit("' ("), F.col("posts").cast("string"), F.lit(" posts)")
        ),
        "alert_key": F.concat_ws(":", F.lit(alert_type), "topic", F.unix_micros("window_start").cast("string")),
        "time": F.col("window_start"),
    })
