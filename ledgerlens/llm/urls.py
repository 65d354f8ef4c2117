"""URL filters: a temporal list join.

A list is a history: entries with a kind (`host`: the host and all hosts under it; `url`: addresses that begin with it up
to a /, ?, # or the end), a value, a category, a date and an action, `add` or `remove`. `validity` turns the history into
intervals during which an entry holds. `judge` joins every capture with the entries active when it was fetched.

A capture asks for its host and all domains above it and for all prefixes of its address, but only of as many labels or
steps as some entry has: equality look-ups, no pattern matching. Intervals are cut at months and joined on (kind, value, month), which
spreads a value with very many captures or entries over the months; what lies in one month is compared by time. A
capture's keys are distinct before the join, and captures alike in address and time are looked up once.

An entry holds from its date on; a removal ends it at its own date. Of several actions of one date the removal counts. Repeated
entries change nothing. Entries without kind, value, date or with another action are ignored. Captures with a null address
or time are never blocked; null categories are kept as "none".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.lines import host

ADD, REMOVE = "add", "remove"
FOREVER = "9999-12-31 00:00:00"


def address(url: Column) -> Column:
    """An address without scheme, user, port and fragment, host in lower case: the form that entries of kind `url` have."""
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^#]*)", 1)
    return F.concat(host(url), rest)


def validity(entries: DataFrame) -> DataFrame:
    """Intervals (kind, value, category, valid_from, valid_to) of a history (kind, value, category, listed_at, action)."""
    history = entries.where(F.col("kind").isin("host", "url") & F.col("value").isNotNull() & F.col("listed_at").isNotNull() & F.col("action").isin(ADD, REMOVE))
    key = ["kind", "value", "category"]
    # One action for each date; then only changes count.
    dated = history.withColumn("category", F.coalesce("category", F.lit("none"))).groupBy(*key, "listed_at").agg(F.max(F.col("action") == REMOVE).alias("off"))
    line = Window.partitionBy(*key).orderBy("listed_at")
    changes = dated.withColumn("before", F.lag("off", 1, True).over(line)).where(F.col("before") != F.col("off"))
    ended = changes.withColumn("valid_to", F.coalesce(F.lead("listed_at").over(line), F.lit(FOREVER).cast("timestamp")))
    return ended.where(~F.col("off")).select(*key, F.col("listed_at").alias("valid_from"), "valid_to")


def _month(t: Column) -> Column:
    return F.year(t) * 12 + F.month(t) - 1


def _labels(name: Column) -> Column:
    return F.split(name, r"\.")


def _steps(whole: Column) -> Column:
    # Cut before each / or ?.
    return F.split(whole, r"(?=[/?])")


def keys(url: Column, labels: Column | None = None, steps: Column | None = None) -> Column:
    """What a capture asks for: array of (kind, value), of the numbers of labels and of steps given (arrays; by default of all)."""
    name, whole = host(url), address(url)

    def asked(parts: Column, kind: str, numbers: Column | None, join) -> Column:
        every = F.sequence(F.lit(1), F.size(parts))
        wanted = every if numbers is None else F.filter(numbers, lambda i: i <= F.size(parts))
        return F.transform(wanted, lambda i: F.struct(F.lit(kind).alias("kind"), join(parts, i).alias("value")))

    hosts = asked(_labels(name), "host", labels, lambda p, i: F.array_join(F.slice(p, F.size(p) - i + 1, i), "."))
    paths = asked(_steps(whole), "url", steps, lambda p, i: F.array_join(F.slice(p, 1, i), ""))
    return F.when(name.isNotNull(), F.concat(hosts, paths))


def judge(captures: DataFrame, intervals: DataFrame, url: str = "url", at: str = "fetched_at", until: str | None = None) -> DataFrame:
    """captures with blocked, n_entries (active entries that match) and category (the first by name).

    `until` is the last month that intervals are cut to; by default that of the last capture.
    """
    rows = captures.drop("blocked", "n_entries", "category")
    asked = rows.select(F.col(url).alias("__u"), F.col(at).alias("__t")).where(F.col("__u").isNotNull() & F.col("__t").isNotNull()).distinct()
    span = captures.agg(F.min(_month(F.col(at))).alias("__first"), F.max(_month(F.col(at))).alias("__last"))
    # One row with the first and last month: joined to the list, not to the captures.
    cut = intervals.join(F.broadcast(span)).where((_month(F.col("valid_from")) <= F.col("__last")) & (_month(F.col("valid_to")) >= F.col("__first")))
    months = F.sequence(F.greatest(_month(F.col("valid_from")), F.col("__first")), F.least(_month(F.col("valid_to")), F.col("__last")))
    cut = cut.select("kind", "value", "category", "valid_from", "valid_to", F.explode(months).alias("month"))
    # The numbers of labels and steps that occur in the list: one row.
    value = F.col("value")
    held = intervals.agg(F.collect_set(F.when(F.col("kind") == "host", F.size(_labels(value)))).alias("__labels"),
                         F.collect_set(F.when(F.col("kind") == "url", F.size(_steps(value)))).alias("__steps"))
    asked = asked.join(F.broadcast(held))
    wanted = asked.select("__u", "__t", _month(F.col("__t")).alias("month"), F.explode(keys(F.col("__u"), F.col("__labels"), F.col("__steps"))).alias("k")).select("__u", "__t", "month", "k.kind", "k.value")
    hits = wanted.join(cut, ["kind", "value", "month"]).where((F.col("valid_from") <= F.col("__t")) & (F.col("__t") < F.col("valid_to")))
    found = hits.groupBy("__u", "__t").agg(F.count(F.lit(1)).alias("n_entries"), F.min("category").alias("category"))
    joined = rows.join(found, (rows[url] == found["__u"]) & (rows[at] == found["__t"]), "left")
    n = F.coalesce(F.col("n_entries"), F.lit(0)).cast("long")
    return joined.select(*rows.columns, (n > 0).alias("blocked"), n.alias("n_entries"), "category")
