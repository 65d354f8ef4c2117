"""N-gram Jaccard join with a token-group matrix; result: components of texts linked at a Jaccard of 80 % or more.

A text's set is its distinct five-word shingles (ASCII letters in lower case), as 64-bit hashes. Texts with equal sets are one node.

Shared tokens. Order all tokens the same way; two sets with a Jaccard of t share a token among the first n - ceil(t n) + 1
of each, their prefixes. The order is by hash, but the tokens found in very many texts (HOT, at most MOST_HOT of them, so they can be
broadcast) go last, rare ones first. Any such order loses no pair. All tokens with a hash below COUNTED are counted over the whole
corpus; of these only tokens that occur twice go on (bloom.py), the others go on unseen. Where hot tokens push a text's prefix beyond COUNTED
(long passages shared with others), its further tokens are counted too, over all such texts.

Bound. Of a pair, take the set whose prefix ends first. All tokens that the other set shares with this prefix lie in the
other's prefix too, so the overlap is at most the tokens shared by the prefixes plus the rest of the set. Pairs whose prefixes share too few
tokens for a Jaccard of t are left out without looking at their sets. That keeps apart texts that only share a passage.

Stars. Each token names up to STARS of its nodes, those that share most of their tokens with others: an original rather than its edited copies.
Every node is compared with the TRIED nodes that most of its tokens name; links join nodes to families. That brings copies and near
copies of one text together with a few comparisons a node, however large the family.

Matrix. What is left are pairs of different families that share a token. Large families are cut into groups of about GROUP nodes. Nodes of
small ones are grouped across families, by size and by the most common of their tokens, so that texts which share a passage but are not linked
stand together. The matrix
holds for each group the union of its members' prefix tokens, their range of sizes and of prefix ends. A query node of the smaller family counts its
prefix tokens in the group's union, which bounds the overlap with every member as above; only groups that can reach t are opened, that is,
compared member by member; in a group of several families only with members that the same bound lets pass alone. Of two groups one asks the other, and a group
of several families asks itself too. Pairs inside a family need no comparison: they are connected already. This is done for families of LARGE nodes or more first, so that
their outlying members join them before they are compared with each other, then for all.

Exact, up to collisions of 64-bit hashes. Null, empty and wordless texts have no set and are linked with nothing; texts with fewer than five words have one
shingle, the whole sequence. Repeated rows and repeated ids are nodes by their set; a component's id is the least id in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm import bloom, grid
from ledgerlens.llm.common import WORDS_PER_SHINGLE, Scratch, map_arrow, saved
from ledgerlens.llm.components import components

PERCENT = 80
# Tokens of the lowest 30 % of hashes are counted.
COUNTED = int(0.3 * 2 ** 64)
HOT, MOST_HOT = 8, 1 << 20
STARS, TRIED = 16, 4
# Nodes of a group, tokens of its sets (about), nodes of a family that is large.
GROUP, GROUP_TOKENS, LARGE = 64, 1 << 16, 16


def sets(chunk: grid.Chunk, size: int = WORDS_PER_SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    token, row, count = chunk.shingles(size, lower=True)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        start, end, of = chunk.words()
        lower = grid._LOWER[chunk.data]
        word = chunk.span(chunk.prefix(lower), start, end, lower)
        at = np.cumsum(count) - count
        whole = np.zeros(len(short), grid.U)
        for k in range(size - 1):
            has = count[short] > k
            whole[has] += word[at[short[has]] + k] * grid._PLACES[k]
        token = np.concatenate([token, grid.mix(whole ^ count[short].astype(grid.U))])
        row = np.concatenate([row, short])
        order = np.argsort(row, kind="stable")
        token, row = token[order], row[order]
    ends = np.searchsorted(row, np.arange(chunk.rows + 1))
    out = []
    for a, b in zip(ends[:-1], ends[1:]):
        t = np.sort(token[a:b])
        out.append(t[np.concatenate([[True], t[1:] != t[:-1]])] if b - a > 1 else t)
    return out


def _prefix(n: int, percent: int) -> int:
    return n + (-percent * n) // 100 + 1


def _find(known: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each token in the sorted known ones, and whether it is there."""
    at = np.minimum(np.searchsorted(known, tokens), max(len(known) - 1, 0))
    return at, known[at] == tokens if len(known) else np.zeros(len(tokens), bool)


def _counts(texts: DataFrame, known: Broadcast | None, percent: int) -> DataFrame:
    """Tokens that occur in two texts or more, and in how many. With `known` hot tokens: only those at COUNTED and above, over the texts whose
    counted tokens are so hot that the prefix goes on beyond them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in grid.chunks(batch.column(0), 1 << 21):
                part = []
                for t in sets(chunk):
                    low, high = np.split(t, [np.searchsorted(t, grid.U(COUNTED))])
                    if known is None:
                        part.append(low)
                    elif len(t):
                        is_hot = _find(known.value[0], low)[1]
                        if is_hot.any() and len(low) - is_hot.sum() < _prefix(len(t), percent):
                            part.append(high)
                token, number = np.unique(np.concatenate(part), return_counts=True) if part else (np.zeros(0, grid.U), np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(number)], ["token", "n"])

    return map_arrow(texts, count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where("n > 1")


def _hot(shared: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The tokens in more than HOT texts (or a higher bound, if those are more than MOST_HOT), in order, and their counts."""
    # From a count of tokens by size (at most 64 rows): the least bound above which there are few enough.
    by_size = {r["s"]: r["k"] for r in shared.groupBy(F.floor(F.log2("n")).alias("s")).agg(F.count(F.lit(1)).alias("k")).collect()}
    bound = HOT
    while sum(k for s, k in by_size.items() if 2 ** (s + 1) > bound) > MOST_HOT:
        bound *= 2
    found = shared.where(F.col("n") > bound).toArrow()
    token = found["token"].to_numpy().view(grid.U)
    order = np.argsort(token)
    return token[order], found["n"].to_numpy()[order]


def _sets_table(df: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """__id, n, sid (hash of the set), hits (prefix tokens that may join it with others), end_n and end_t (place of the prefix' last
    token in the order of tokens)."""
    spark = df.sparkSession
    texts = df.select(F.col(text_col).alias("__text"))

    scratch = Scratch(spark)
    low = scratch.save(_counts(texts, None, percent), "tokens")
    some = spark.sparkContext.broadcast(_hot(low))
    more = scratch.save(_counts(texts, some, percent), "tokens")
    some.destroy()
    shared = low.union(more)
    hot_token, hot_count = _hot(shared)
    heavy = spark.sparkContext.broadcast((hot_token, hot_count))
    twice = bloom.build(low, "token", low.count())
    rows = df.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    kind = rows.schema[0].dataType.simpleString()

    def list_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_token, hot_count = heavy.value
        for batch in batches:
            for chunk in grid.chunks(batch.column(1)):
                found = sets(chunk)
                flat = np.concatenate(found) if found else np.zeros(0, grid.U)
                at, is_hot = _find(hot_token, flat)
                size = np.array([len(t) for t in found])
                ends = np.cumsum(size)
                sid = _sid(flat, size)
                first, ends_n, ends_t = [], [], []
                for t, e, n in zip(found, ends, size.tolist()):
                    wanted = _prefix(n, percent) if n else 0
                    heavy_here, last_n = is_hot[e - n:e], 0
                    if heavy_here[:wanted].any():
                        pre = t[~heavy_here][:wanted]
                        if len(pre) < wanted:
                            rest = np.flatnonzero(heavy_here)
                            number = hot_count[at[e - n:e][rest]]
                            taken = np.argsort(number, kind="stable")[:wanted - len(pre)]
                            last_n = int(number[taken[-1]])
                            pre = np.concatenate([pre, t[rest[taken]]])
                    else:
                        pre = t[:wanted]
                    first.append(pre)
                    ends_n.append(last_n)
                    # Unsigned hashes in signed order.
                    ends_t.append(int(pre[-1]) - (1 << 63) if wanted else 0)
                flat = np.concatenate(first) if first else flat
                of = np.repeat(np.arange(len(first)), [len(p) for p in first])
                passed = flat >= grid.U(COUNTED)
                low = np.flatnonzero(~passed)
                passed[low] = bloom.test(twice.value, flat[low])
                flat, of = flat[passed], of[passed]
                number = np.bincount(of, minlength=len(found))
                offsets = np.concatenate([[0], np.cumsum(number)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, chunk.rows), pa.array(size, pa.int64()), pa.array(sid.view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64))),
                     pa.array(ends_n, pa.int64()), pa.array(ends_t, pa.int64())], ["__id", "n", "sid", "hits", "end_n", "end_t"])

    table = saved(map_arrow(rows, list_, f"__id {kind}, n long, sid long, hits array<long>, end_n long, end_t long"), "nodes")
    heavy.destroy()
    twice.destroy()
    scratch.drop_all_but(0)
    return table


def _sid(flat: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of each of the sets that lie one after another in flat."""
    ends = np.cumsum(size)
    sums = np.concatenate([np.zeros(1, grid.U), np.cumsum(grid.mix(flat ^ grid.U(0x51D)), dtype=grid.U)])
    return grid.mix((sums[ends] - sums[ends - size]) ^ grid.mix(size.astype(grid.U)))


def _tokens(df: DataFrame, text_col: str, needed: DataFrame, scratch: Scratch) -> DataFrame:
    """sid and tokens (binary) of the needed nodes (sid), made again from the texts: far less to store than all sets."""
    needed = scratch.save(needed.distinct(), "needed")
    wanted = bloom.build(needed, "sid", needed.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in grid.chunks(batch.column(0), 1 << 21):
                found = sets(chunk)
                sid = _sid(np.concatenate(found), np.array([len(t) for t in found])) if found else np.zeros(0, grid.U)
                _, once = np.unique(sid, return_index=True)
                once = once[bloom.test(wanted.value, sid[once])]
                yield pa.RecordBatch.from_arrays([pa.array(sid[once].view(np.int64)), pa.array([found[i].tobytes() for i in once], pa.binary())], ["sid", "tokens"])

    made = map_arrow(df.select(F.col(text_col).alias("__text")), run, "sid long, tokens binary").groupBy("sid").agg(F.any_value("tokens").alias("tokens"))
    tokens = scratch.save(made, "sets")
    wanted.destroy()
    return tokens


def _verify(pairs: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """Of the stars' pairs (a, b) of nodes those that are linked."""
    return _linked(pairs, tokens, percent)


def _linked(pairs: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) of nodes those that are linked."""
    left = tokens.select(F.col("sid").alias("a"), F.col("tokens").alias("ta"))
    right = tokens.select(F.col("sid").alias("b"), F.col("tokens").alias("tb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), grid.U), np.frombuffer(y.as_buffer(), grid.U)
                common = _overlap(x, y)
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return map_arrow(both, check, "a long, b long")


def _overlap(x: np.ndarray, y: np.ndarray) -> int:
    if len(x) > len(y):
        x, y = y, x
    if not len(y):
        return 0
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())


def _fit(n: Column, m: Column, percent: int) -> Column:
    """Sizes that a linked pair can have."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _need(n: Column, m: Column, first: Column, percent: int) -> Column:
    """Tokens that the prefixes of a pair of sizes n and m must share; `first`: the prefix of n ends before that of m.

    The overlap of a linked pair is at least t (n + m) / (1 + t). The rest of a set after its prefix has ceil(t n) - 1 tokens.
    """
    overlap = F.ceil(F.lit(percent) * (n + m) / F.lit(100.0 + percent) - 1e-9)
    rest = F.ceil(F.lit(percent) * F.when(first, n).otherwise(m) / F.lit(100.0) - 1e-9) - 1
    return F.greatest(F.lit(1), overlap - rest)


def _mixed(left: DataFrame, small: DataFrame, percent: int) -> DataFrame:
    """Groups (sid, mixed) of nodes of small families: alike in size, with the same most common token, about GROUP of them."""
    common = left.groupBy("token").agg(F.count(F.lit(1)).alias("c"))
    anchors = left.join(common, "token").groupBy("sid", "n").agg(F.max(F.struct("c", "token")).alias("m")).select("sid", "n", F.col("m.token").alias("anchor"))
    # Sizes of one class can be linked with those of the next ones at most.
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent))).alias("class")
    nodes = anchors.join(small, "sid", "left_semi").select("sid", "n", "anchor", size_class)
    sizes = nodes.groupBy("anchor", "class").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("all"))
    parts = F.ceil(F.greatest(F.col("size") / GROUP, F.col("all") / GROUP_TOKENS))
    mixed = F.xxhash64("anchor", "class", F.pmod(F.xxhash64("sid", F.lit(-2)), parts)).alias("mixed")
    return nodes.join(sizes, ["anchor", "class"]).select("sid", mixed)


def _met(places: DataFrame, named: DataFrame, percent: int, least_size: int, scratch: Scratch, before: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tokens of query nodes with the groups whose matrix holds them (of families of least_size nodes or more); all groups; all open tokens."""
    families = places.join(named, F.col("sid") == F.col("node"), "left").select("token", "sid", "n", "end", F.coalesce("component", "sid").alias("family"))
    # Read twice below; kept, so that places are dealt out by node once.
    brief = Scratch(places.sparkSession)
    families = brief.save(families, "families")
    # Tokens that still lie in several families.
    open_ = families.groupBy("token").agg(F.min("family").alias("x"), F.max("family").alias("y")).where("x <> y").select("token")
    left = scratch.save(families.join(open_, "token", "left_semi"), "open")
    brief.drop_all_but(0)
    members = left.select("sid", "n", "end", "family").distinct()
    sizes = members.groupBy("family").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("all"))
    parts = F.ceil(F.greatest(F.col("size") / GROUP, F.col("all") / GROUP_TOKENS))
    gid = F.xxhash64("family", F.pmod(F.xxhash64("sid", F.lit(-1)), parts), F.lit(before is not None))
    grouped = members.join(sizes, "family").withColumn("gid", gid).drop("all")
    if before is not None:
        old = before.select("sid", F.col("gid").alias("old"))
        grouped = grouped.join(old, "sid", "left").withColumn("gid", F.coalesce("old", "gid")).drop("old")
    # Groups of small families have rank 0 and members of several families.
    grouped = grouped.withColumn("rank", F.when(F.col("size") >= LARGE, F.col("size")).otherwise(0))
    if least_size < LARGE:
        mixed = _mixed(left, grouped.where(F.col("rank") == 0).select("sid"), percent)
        grouped = grouped.join(mixed, "sid", "left").withColumn("gid", F.coalesce("mixed", "gid")).drop("mixed")
    grouped = saved(grouped, "groups")
    rows = left.select("token", "sid").join(grouped, "sid")
    matrix = rows.where(F.col("size") >= least_size).select("token", "gid").distinct()
    group = grouped.groupBy("gid").agg(
        F.first("family").alias("g_family"), F.first("rank").alias("g_rank"), F.min("n").alias("low"), F.max("n").alias("high"),
        F.min("end").alias("g_first"), F.max("end").alias("g_last"))
    asks = (F.struct("rank", "gid") < F.struct("g_rank", "g_gid")) & ((F.col("g_rank") == 0) | (F.col("family") != F.col("g_family")))
    asks |= (F.col("g_rank") == 0) & (F.col("gid") == F.col("g_gid"))
    in_size = (F.col("high") * 100 >= F.col("n") * percent) & (F.col("n") * 100 >= F.col("low") * percent)
    there = matrix.join(group, "gid").withColumnRenamed("gid", "g_gid")
    return rows.select("token", "sid", "n", "end", "family", "rank", "gid").join(there, "token").where(asks & in_size), grouped, left


def _members(left: DataFrame, grouped: DataFrame, opened: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of a node and a member of an opened group of several families, whose prefixes share enough tokens."""
    own = grouped.where(F.col("rank") == 0).select(F.col("sid").alias("b"), "gid")
    member = left.select("token", F.col("sid").alias("b"), F.col("n").alias("m"), F.col("end").alias("b_end"), F.col("family").alias("b_family")).join(own, "b")
    both = left.join(opened, "sid").join(member, ["token", "gid"]).where((F.col("family") != F.col("b_family")) & _fit(F.col("n"), F.col("m"), percent))
    votes = both.groupBy("sid", "b", "n", "m", (F.col("end") <= F.col("b_end")).alias("first")).agg(F.count(F.lit(1)).alias("k"))
    enough = votes.where(F.col("k") >= _need(F.col("n"), F.col("m"), F.col("first"), percent))
    return enough.select(F.least("sid", "b").alias("a"), F.greatest("sid", "b").alias("b")).distinct()


def _opened(places: DataFrame, named: DataFrame, percent: int, least_size: int, scratch: Scratch,
            before: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """Nodes with the groups of large families that the matrix cannot rule out (sid, gid); pairs (a, b) of nodes of small ones, of
    least_size nodes or more; and all groups.

    `before`: groups (sid, gid) that stay as they are.
    """
    met, grouped, left = _met(places, named, percent, least_size, scratch, before)
    met = met.select("sid", F.col("g_gid").alias("gid"), "g_rank", "n", "end", "low", "high", "g_first", "g_last")
    counted = met.groupBy("sid", "gid", "g_rank", "n", "end", "low", "high", "g_first", "g_last").agg(F.count(F.lit(1)).alias("k"))
    # What the query must share with a member that ends after it grows with the member's size. With one that ends before it, it falls by
    # t^2 / (1 + t) a size but for rounding, which moves it by less than one: the least lies among the largest sizes over which it falls by one.
    n = F.col("n")
    small, large = F.greatest("low", F.ceil(n * percent / 100.0 - 1e-9)), F.least("high", F.floor(n * 100.0 / percent + 1e-9))
    after = F.when(F.col("end") <= F.col("g_last"), _need(n, small, F.lit(True), percent))
    last = -(-100 * (100 + percent) // percent ** 2)
    least = F.least(*[_need(n, F.greatest(small, large - k), F.lit(False), percent) for k in range(last)])
    ahead = F.when(F.col("end") > F.col("g_first"), least)
    opened = scratch.save(counted.where(F.col("k") >= F.least(after, ahead)).select("sid", "gid", "g_rank"), "opened")
    small = opened.where(F.col("g_rank") == 0).select("sid", "gid")
    pairs = scratch.save(_members(left, grouped, small, percent), "pairs") if least_size < LARGE else None
    return opened.where(F.col("g_rank") > 0).select("sid", "gid"), pairs, grouped.select("sid", "gid", "size")


def _compare(opened: DataFrame, pairs: DataFrame | None, grouped: DataFrame, df: DataFrame, text_col: str, percent: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) between nodes and the members of the groups opened for them, whose sets travel as one row, and of the pairs."""
    inside = grouped.join(opened.select("gid").distinct(), "gid", "left_semi").select("gid", F.col("sid").alias("b"))
    needed = opened.select("sid").union(inside.select("b"))
    if pairs is not None:
        needed = needed.union(pairs.select(F.explode(F.array("a", "b"))))
    tokens = _tokens(df, text_col, needed, scratch)
    held = inside.join(tokens, F.col("b") == F.col("sid")).groupBy("gid").agg(F.collect_list("b").alias("b"), F.collect_list("tokens").alias("sets"))
    met = opened.join(tokens, "sid").join(held, "gid").select("sid", "tokens", "b", "sets")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for sid, x, members, sets_ in zip(*(batch.column(i) for i in range(4))):
                x = np.frombuffer(x.as_buffer(), grid.U)
                ids, y = members.values.to_numpy(), [np.frombuffer(v.as_buffer(), grid.U) for v in sets_.values]
                size = np.array([len(v) for v in y])
                # Tokens of each member that are in x.
                inside = _find(x, np.concatenate(y))[1]
                common = np.add.reduceat(inside, np.cumsum(size) - size, dtype=np.int64)
                good = ids[100 * common >= percent * (len(x) + size - common)]
                a.append(np.full(len(good), sid.as_py()))
                b.append(good)
            a, b = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (a, b))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    found = map_arrow(met, check, "a long, b long")
    return found if pairs is None else found.union(_linked(pairs, tokens, percent))


def _places(table: DataFrame, scratch: Scratch) -> DataFrame:
    """token, sid, n, end, shared (prefix tokens that may join the node with others) of the tokens that several nodes hold."""
    # Equal sets have equal rows: one of them is taken while the tokens are still a list, which is far shorter than a row for each.
    end = F.struct("end_n", "end_t").alias("end")
    nodes = scratch.save(table.where(F.size("hits") > 0).select("sid", "n", end, "hits").dropDuplicates(["sid"]), "distinct")
    places = nodes.select("sid", "n", "end", F.size("hits").alias("shared"), F.explode("hits").alias("token"))
    # A node holds a token once.
    several = places.groupBy("token").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("token")
    places = saved(places.join(several, "token", "left_semi").select("token", "sid", "n", "end", "shared"), "places")
    scratch.drop_all_but(0)
    return places


def links(df: DataFrame, text_col: str, table: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) between nodes of a table from _sets_table: enough of them that every linked pair is connected."""
    # What a step has stored goes as soon as its links are.
    scratch = Scratch(df.sparkSession)
    places = _places(table, scratch)
    # The stars of a token: of its nodes in each of STARS parts the one with the largest part (in thousandths) of its tokens shared. What
    # travels for each token is short: hashes and fractions hardly compress.
    part_shared = F.floor(F.col("shared") * 1000 / F.col("n"))
    least = F.min(F.struct((-part_shared).cast("int").alias("s"), F.col("sid").alias("b"), F.col("n").alias("m"), F.col("end").alias("b_end"))).alias("s")
    stars = places.groupBy("token", F.pmod(F.xxhash64("sid", F.lit(0)), F.lit(STARS)).alias("part")).agg(least).select("token", "s.b", "s.m", "s.b_end")
    named = places.join(stars, "token").where((F.col("sid") != F.col("b")) & _fit(F.col("n"), F.col("m"), percent))
    # Half of the needed votes is enough to try: this step may miss pairs, the next one finds them.
    need = _need(F.col("n"), F.col("m"), F.col("end") <= F.col("b_end"), percent).alias("need")
    tried = named.groupBy(F.col("sid").alias("a"), "b", need).agg(F.count(F.lit(1)).alias("k")).where("2 * k >= need")
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("k"), "b"))
    best = tried.withColumn("rank", rank).where(F.col("rank") <= TRIED)
    pairs = best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = scratch.save(pairs, "stars")
    tokens = _tokens(df, text_col, pairs.select(F.explode(F.array("a", "b")).alias("sid")), scratch)
    found = saved(_verify(pairs, tokens, percent), "linked")
    scratch.drop_all_but(0)
    # Large families take in their outlying members before these are compared with each other.
    opened, _, groups = _opened(places, components(found), percent, LARGE, scratch)
    found = saved(found.union(_compare(opened, None, groups, df, text_col, percent, scratch)), "linked")
    opened = saved(opened, "asked")
    scratch.drop_all_but(0)
    other, pairs, groups = _opened(places, components(found), percent, 1, scratch, groups.where(F.col("size") >= LARGE))
    other = scratch.save(other.join(opened, ["sid", "gid"], "left_anti"), "opened")
    found = saved(found.union(_compare(other, pairs, groups, df, text_col, percent, scratch)), "links")
    scratch.drop_all_but(0)
    return found


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per row of df: id_col, n_shingles, component_id (least id of the texts connected by links)."""
    table = _sets_table(df, id_col, text_col, percent)
    found = components(links(df, text_col, table, percent))
    nodes = table.where("n > 0").groupBy("sid").agg(F.min("__id").alias("least"))
    whole = nodes.join(found, F.col("sid") == F.col("node"), "left").select("sid", "least", F.coalesce("component", "sid").alias("component"))
    ids = whole.groupBy("component").agg(F.min("least").alias("component_id"))
    named = saved(whole.join(ids, "component").select(F.col("sid").alias("__sid"), "component_id"), "components")
    rows = table.select("__id", "n", F.when(F.col("n") > 0, F.col("sid")).alias("sid")).join(named, F.col("sid") == F.col("__sid"), "left")
    return rows.select(F.col("__id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("__id")).alias("component_id"))
