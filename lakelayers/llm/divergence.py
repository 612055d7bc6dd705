"""How far sources of a language diverge in their terms, by a frequent-pattern tree of term rows.

Each term kept in a language is a row of its nonzero counts, in order of source. Equal rows are put
together with their multiplicity, sorted and cut into ranges, and each task inserts its range into a
tree: as the rows come sorted, only the current path is held. A node is a source with a count; rows
that begin alike share it. When a node is complete its multiplicity goes to its parent, and each pair of
the node and one of its ancestors is handed on once, however many terms share it.

The divergence of two sources is a sum over all kept terms. Terms that neither has make up a base that
follows from the number of terms; a histogram of counts by source corrects it for terms that one has, and
the pairs of the tree correct it for terms that both have. All numbers are integers: exact at any size.

Nothing is broadcast on purpose. Terms are counted in tasks before they are shuffled, so a hot source or
term sends one row a flush. A row holds the sources of one term, a task the path of one row; pairs are as
many as the result itself asks for. The sources of a language meet in a join on the language and a salt.

Defined cases: null text, language and source count as empty texts. A source without a kept term has the
counts zero. A language without any has pairs of value 0 and no terms. Equal values are ranked by item, in
order of its UTF-8 bytes. Repeated rows, and rows of equal id, are documents of their own; ids are not
read. A term of over a megabyte is read whole; longer texts are counted in parts, and their distinct terms
in several passes, one for each ``PASS_BYTES``. An empty table gives an empty one. Other columns may have
any name.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayers.llm.shipping import ship
from lakelayers.llm.words import LOWER, text_bytes
from lakelayers.scratch import stage

MIN_DOCS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
HELD = 600_000
PART_BYTES = 1 << 20
PASS_BYTES = 32 << 20
SALTS = 16

_TERM = re.compile(rb"[a-z\x80-\xff]+")  # after A-Z are in lower case
_TERM_BYTE = np.zeros(256, bool)
_TERM_BYTE[[*range(97, 123), *range(128, 256)]] = True


def text_parts(data: np.ndarray, limit: int = PART_BYTES) -> Iterator[bytes]:
    """Parts of about ``limit`` bytes that cut no term; the bytes are in lower case already."""
    at = 0
    while at < len(data):
        to = min(at + limit, len(data))
        while to < len(data) and _TERM_BYTE[data[to - 1]] and _TERM_BYTE[data[to]]:
            out = np.flatnonzero(~_TERM_BYTE[data[to : to + limit]])
            to = min(to + (int(out[0]) if len(out) else limit), len(data))
        yield data[at:to].tobytes()
        at = to


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, n, docs: partial counts; the empty term stands for the group itself."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            columns = [
                pa.array([lang] * len(terms), pa.string()),
                pa.array([source] * len(terms), pa.string()),
                pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array(list(n.values()), pa.int64()),
                pa.array([docs[term] for term in terms], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        data, bounds = text_bytes(batch.column("text"))
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for row, group in enumerate(zip(langs, sources, strict=True)):
            n, docs = held.setdefault(group, (Counter({b"": 0}), Counter()))
            text = LOWER[data[bounds[row] : bounds[row + 1]]]
            passes = 1 + len(text) // PASS_BYTES
            for own in range(passes):
                seen: set[bytes] = set()
                for part in text_parts(text):
                    terms = _TERM.findall(part)
                    if passes > 1:
                        terms = [term for term in terms if zlib.crc32(term) % passes == own]
                    before = len(n)
                    n.update(terms)
                    fresh = set(terms) - seen if seen else set(terms)
                    docs.update(fresh)
                    size += len(n) - before
                    if len(text) > PART_BYTES:
                        seen |= fresh
                    if size > HELD:
                        yield from flush()
                        held.clear()
                        n, docs = held.setdefault(group, (Counter({b"": 0}), Counter()))
                        size = 0
    yield from flush()


def term_counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, term, n (occurrences), docs (rows that have it), and a row of the empty term for
    each group that occurs."""
    ship(df.sparkSession)
    columns = ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))
    docs = df.select(*[F.coalesce(F.col(old).cast("string"), F.lit("")).alias(new) for old, new in columns])
    parts = docs.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    # Counted in tasks already: one shuffle serves this grouping and that of term_rows.
    dealt = parts.repartition("lang", "term")
    return dealt.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def term_rows(counts: DataFrame) -> DataFrame:
    """lang, term, docs, total, counts (source and n, in order of source) from :func:`term_counts`; the row
    of the empty term has all sources of its language."""
    pairs = F.sort_array(F.collect_list(F.struct("source", "n")))
    return counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), pairs.alias("counts"))


class PatternTree:
    """A tree of (source, count) nodes, of which only the current path is held.

    ``insert`` takes rows in sorted order. ``pairs`` gathers, for each node left behind and each of its
    ancestors, the number of terms that share them.
    """

    def __init__(self) -> None:
        self.path: list[list] = []
        self.pairs: dict[tuple, int] = {}

    def _leave(self, depth: int) -> None:
        path, pairs = self.path, self.pairs
        while len(path) > depth:
            source, count, terms = path.pop()
            if path:
                path[-1][2] += terms
            for above, of_above, _ in path:
                key = (above, of_above, source, count)
                pairs[key] = pairs.get(key, 0) + terms

    def insert(self, row: list[tuple[str, int]], terms: int) -> None:
        shared = 0
        for (source, count), node in zip(row, self.path, strict=False):
            if node[0] != source or node[1] != count:
                break
            shared += 1
        self._leave(shared)
        self.path.extend([source, count, 0] for source, count in row[shared:])
        if self.path:
            self.path[-1][2] += terms

    def close(self) -> None:
        self._leave(0)

    def take(self) -> dict[tuple, int]:
        taken, self.pairs = self.pairs, {}
        return taken


def _tree_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tree, lang = PatternTree(), None

    def pairs() -> pa.RecordBatch:
        taken = tree.take()
        a, n_a, b, n_b = zip(*taken, strict=True)
        kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        columns = [[lang] * len(taken), a, n_a, b, n_b, list(taken.values())]
        arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["lang", "a", "n_a", "b", "n_b", "terms"])

    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            part = batch.slice(start, 1024)
            langs, rows, terms = (part.column(c).to_pylist() for c in ("lang", "counts", "terms"))
            for own, row, many in zip(langs, rows, terms, strict=True):
                if own != lang:
                    tree.close()
                    if tree.pairs:
                        yield pairs()
                    lang = own
                tree.insert([(item["source"], item["n"]) for item in row], many)
                if len(tree.pairs) > HELD:
                    yield pairs()
    tree.close()
    if tree.pairs:
        yield pairs()


def tree_pairs(rows: DataFrame) -> DataFrame:
    """lang, a, n_a, b, n_b, terms: how many terms have the count n_a in source a and n_b in source b,
    a before b, for all pairs of nonzero counts. ``rows`` has lang, counts (sorted) and terms."""
    ship(rows.sparkSession)
    ranged = rows.select("lang", "counts", "terms").repartitionByRange("lang", "counts").sortWithinPartitions("lang", "counts")
    found = ranged.mapInArrow(_tree_pairs, "lang string, a string, n_a long, b string, n_b long, terms long")
    return found.groupBy("lang", "a", "n_a", "b", "n_b").agg(F.sum("terms").alias("terms"))


def share(count: Column, room: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / room), exact for counts of any size."""
    scaled = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", scaled, room.cast("decimal(20,0)"))


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def source_divergence(
    df: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_docs: int = MIN_DOCS,
    top_terms: int = TOP_TERMS,
) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank."""
    rows = term_rows(term_counts(df, text_col, lang_col, source_col))
    rows = stage(rows.filter((F.col("docs") >= min_docs) | (F.col("term") == "")).drop("docs"), "term-rows")
    kept = rows.filter("term <> ''")
    each = kept.select("lang", "term", "total", F.inline("counts"))

    langs = rows.filter("term = ''").select("lang")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    langs = langs.join(sizes, "lang", "left").na.fill(0, ["v", "lang_n"])
    groups = rows.filter("term = ''").select("lang", F.explode("counts.source").alias("source"))
    groups = groups.join(each.groupBy("lang", "source").agg(F.sum("n").alias("group_n")), ["lang", "source"], "left")
    groups = groups.na.fill(0, ["group_n"]).join(langs, "lang").withColumn("room", F.col("group_n") + F.col("v"))
    zero = F.when(F.col("v") > 0, share(F.lit(0), F.col("room")))
    groups = groups.withColumn("zero", zero)
    groups = stage(groups.selectExpr("lang", "source", "v", "room", "zero", "lang_n + v lang_room"), "groups")

    pairs = _ranked(_pair_values(kept, each, groups))
    terms = _ranked(_term_values(each, groups)).filter(F.col("rank") <= top_terms)
    columns = ("lang", "source", "part", "item", "value", "rank")
    return pairs.withColumn("part", F.lit("pair")).select(*columns).union(terms.withColumn("part", F.lit("term")).select(*columns))


def _ranked(values: DataFrame) -> DataFrame:
    return values.withColumn("rank", F.expr("row_number() over (partition by lang, source order by value desc, item)"))


def _term_values(each: DataFrame, groups: DataFrame) -> DataFrame:
    own = groups.selectExpr("lang own_lang", "source own_source", "room", "lang_room")
    met = each.join(own, F.expr("lang = own_lang and source = own_source"))
    shares = met.select("lang", "source", F.col("term").alias("item"), share(F.col("n"), F.col("room")).alias("p"), share(F.col("total"), F.col("lang_room")).alias("q"))
    return shares.filter("p > q").select("lang", "source", "item", distance(F.col("p"), F.col("q")).alias("value"))


def _pair_values(kept: DataFrame, each: DataFrame, groups: DataFrame) -> DataFrame:
    p, q, p0, q0 = (F.col(name) for name in ("p", "q", "p0", "q0"))
    others = groups.selectExpr("lang other_lang", "source item", "room other_room", "zero q0")

    # All terms absent from both.
    salted = groups.withColumn("salt", F.pmod(F.xxhash64("source"), F.lit(SALTS)))
    spread = others.withColumn("other_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    same = F.expr("lang = other_lang and salt = other_salt and source <> item")
    base = salted.join(spread, same).select(
        "lang", "source", "item", F.coalesce(F.col("v") * distance(F.col("zero"), q0), F.lit(0)).alias("value")
    )

    # Terms one source has: histogram of its counts against the zero of every other, both ways.
    bars = each.groupBy("lang", "source", "n").agg(F.count("*").alias("terms"))
    own = groups.selectExpr("lang own_lang", "source own_source", "room", "zero p0")
    bars = bars.join(own, F.expr("lang = own_lang and source = own_source"))
    bars = bars.select("lang", "source", "terms", share(F.col("n"), F.col("room")).alias("p"), "p0")
    bars = bars.withColumn("salt", F.pmod(F.xxhash64("source", "p"), F.lit(SALTS)))
    to = F.col("terms") * (distance(p, q0) - distance(p0, q0))
    back = F.col("terms") * (distance(q0, p) - distance(q0, p0))
    single = bars.join(spread, same).select("lang", _both_ways("source", "item", to, back))

    # Terms both have, from the tree.
    rows = kept.groupBy("lang", "counts").agg(F.count("*").alias("terms"))
    one = groups.selectExpr("lang l1", "source s1", "room r1", "zero p0")
    two = groups.selectExpr("lang l2", "source s2", "room r2", "zero q0")
    met = tree_pairs(rows).join(one, F.expr("lang = l1 and a = s1")).join(two, F.expr("lang = l2 and b = s2"))
    met = met.select("lang", "a", "b", "terms", share(F.col("n_a"), F.col("r1")).alias("p"), share(F.col("n_b"), F.col("r2")).alias("q"), "p0", "q0")
    to = F.col("terms") * (distance(p, q) - distance(p, q0) - distance(p0, q) + distance(p0, q0))
    back = F.col("terms") * (distance(q, p) - distance(q0, p) - distance(q, p0) + distance(q0, p0))
    both = met.select("lang", _both_ways("a", "b", to, back))

    values = base.unionByName(single).unionByName(both)
    return values.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _both_ways(a: str, b: str, to: Column, back: Column) -> Column:
    """Two rows: of the first source against the second, and the other way round."""
    def row(source: str, item: str, value: Column) -> Column:
        return F.struct(F.col(source).alias("source"), F.col(item).alias("item"), value.alias("value"))

    return F.inline(F.array(row(a, b, to), row(b, a, back)))
