"""Exact n-gram Jaccard join as a blocked sparse matrix product.

Rows of the matrix are documents, columns their distinct n-grams; a product of two rows
is an overlap. Columns come in one order for all documents, rare ones first. If two rows
of n and m columns reach the threshold, they share one of their first
``n - ceil(t * n) + 1`` and ``m - ceil(t * m) + 1`` columns; and the first that they share
has the needed overlap left in both. So the product is built in two column blocks: the
leading columns give candidate pairs and partial counts, pairs whose sizes, places or
partial counts cannot reach the needed overlap are discarded, and only the others are
multiplied in full.

Components need no complete product. Equal rows are merged beforehand, whatever their
number. Then each leading column names one of its rows as pivot, and each row is multiplied by
the pivot that it shares most leading columns with; what links becomes one component,
and pairs within a component are never formed. Rounds with other pivots follow while they
find links, and the pairs between components that remain are multiplied in full. No pair
is left out: a round drops a column from a row only if no row of another component has it
at a place and with a size that leave a link possible.

Leading columns are held as *entries*: the upper 48 bits of a column's hash and, in the
lower 16, its place in the row. Columns that agree in these bits only, and places beyond
the last that fits, may add candidates and never lose one; the product compares all bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import _text
from .graph import components, stored

#: Counters of the frequency sketch, a byte each. Its size does not follow the data.
COUNTERS = 1 << 23
_PIECES = 64
#: Bits of the map of wanted texts, in rows of 2**15 bits: eight for each text within
#: these bounds, of which the upper one is 8 MB.
_MARK_BITS = 1 << 23, 1 << 26
#: Lower bits of an entry, its place.
_PLACE_BITS = 16
_LAST_PLACE = (1 << _PLACE_BITS) - 1
#: A turn takes place if it has at least this part of the first turn's pairs.
_FEW = 8
#: Partners of a row that are compared with it in one place.
_PARTNERS = 256


class Joined(NamedTuple):
    documents: DataFrame
    links: DataFrame


def join(
    df: DataFrame,
    key: str,
    text: str,
    words: int = 5,
    percent: int = 80,
    star_rounds: int = 4,
) -> Joined:
    """Components of the texts whose n-gram sets are similar.

    ``documents`` has one row per row of ``df``: ``key``, ``n_shingles`` and
    ``component_id``, the smallest key in reach. ``links`` has verified links ``a`` and
    ``b`` between different sets, by their smallest keys, enough to span every
    component. Two sets link if ``100 * overlap >= percent * union``.

    Texts are lower-cased (A-Z) and split at white space. A text of fewer than ``words``
    words has its whole sequence as its one n-gram. Null and empty texts have no n-gram
    and link to nothing; copies of a text share a component, also if their key repeats.
    Rows with a null key take part; a component of such rows only has a null id. Other
    columns of ``df`` are not read. N-grams are compared by 64-bit hashes.

    ``star_rounds`` bounds the pivot rounds only, not what they leave to the last step.
    Each of them and that step shuffles the texts of its pairs, and few others.
    """
    # A row's mark is a hash of its key and text; equal rows have one.
    mark = F.xxhash64(F.col(key).isNull(), key, text)
    docs = df.select(F.col(key).alias("key"), mark.alias("mark"), F.col(text).alias("text"))
    rows = stored(_rows(docs, words), "rows")
    # A node's own row: the least key, and the row's mark as keys may repeat.
    nodes = stored(
        rows.where("node IS NOT NULL")
        .groupBy("node", "n")
        .agg(F.min("key").alias("rep"), F.min(F.struct(F.col("key").isNull(), "key", "mark")).alias("own"))
        .select("node", "n", "rep", F.col("own.mark").alias("mark")),
        "nodes",
    )
    rank = _frequencies(docs, words)
    shared = stored(_shared(docs, words, percent, rank), "shared")
    postings = shared.where("meets").drop("meets")

    links = tested = groups = None
    first = 0
    for turn in range(star_rounds):
        pairs = stored(_pivot_pairs(postings, tested, turn, percent), "pairs")
        # A turn reads all texts; a few pairs are left to the last step, which does so too.
        n_pairs = pairs.count()
        first = first or n_pairs
        if _FEW * n_pairs < first:
            break
        found = stored(_verified(pairs, docs, rows, nodes, words, percent), "found")
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = found if links is None else links.unionByName(found)
        if found.isEmpty():
            break
        groups = stored(components(links), "groups")
        postings = stored(_apart(postings, groups, percent), "postings")
    rest = stored(_open_pairs(postings, shared, tested, percent), "pairs")
    found = stored(_verified(rest, docs, rows, nodes, words, percent), "found")
    if groups is None or not found.isEmpty():
        links = found if links is None else links.unionByName(found)
        groups = components(links)
    return Joined(*_by_key(rows, nodes, links, groups, key))


def _by_key(rows, nodes, links, groups, key):
    rooted = nodes.join(groups, "node", "left").select(
        "node", "rep", F.coalesce("root", "node").alias("root")
    )
    rooted = stored(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = rooted.join(least, "root").select("node", "component_id")
    documents = rows.select("key", "n", "node").join(named, "node", "left")
    documents = documents.select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "key").alias("component_id"),
    )
    ids = rooted.select("node", "rep")
    by_key = (
        links.join(ids.toDF("a", "ka"), "a")
        .join(ids.toDF("b", "kb"), "b")
        .select(F.least("ka", "kb").alias("a"), F.greatest("ka", "kb").alias("b"))
    )
    return documents, by_key


def _shared(docs, words, percent, rank) -> DataFrame:
    """(entry, node, n, lone, meets) of the leading columns that several nodes share.

    ``lone`` are the leading columns that a node has for itself, ``meets`` says whether
    the column leaves a link possible. The place in an entry counts the columns of the
    row before this one, shared or not.
    """
    entries = _leading(docs.select("text"), words, percent, rank)
    entries = entries.select("node", "n", F.explode("leading").alias("entry"))
    # One exchange, after which a column that only one node has is dropped.
    own = Window.partitionBy("column")
    rows = (
        _by_column(entries)
        .withColumns({"lo": F.min("node").over(own), "hi": F.max("node").over(own)})
        .where("lo < hi")
    )
    shared = (
        _with_meets(rows, "node", percent)
        .select("column", "entry", "node", "n", F.coalesce("meets", F.lit(False)).alias("meets"))
        .distinct()
        .drop("column")
    )
    in_common = F.count("*").over(Window.partitionBy("node"))
    return shared.withColumn("lone", _n_leading(F.col("n"), percent) - in_common)


def _column():
    return F.shiftright("entry", _PLACE_BITS)


def _place():
    return F.col("entry").bitwiseAND(F.lit(_LAST_PLACE).cast("long"))


def _by_column(rows: DataFrame) -> DataFrame:
    """Rows with an entry, dealt by ``column``, which is added where they arrive."""
    return rows.repartition(_column()).withColumn("column", _column())


def _n_leading(n, percent: int):
    return n - F.ceil(percent * n / 100) + 1


def _reaches(x: str, y: str, percent: int):
    """Whether a column may be the first that two linking rows share.

    Rows of n and m columns link if at least ``needed`` of them are the same. All of
    these are at or behind the first one, so neither row has fewer left there.
    """
    n, m = F.col(f"{x}n"), F.col(f"{y}n")
    needed = F.ceil(percent * (n + m) / (100 + percent))
    return (n - F.col(f"{x}pos") >= needed) & (m - F.col(f"{y}pos") >= needed)


def _enough(c, n, m, percent: int):
    """Whether rows of n and m columns may link if at most c leading ones are the same.

    They have no more common columns than c and those behind the leading ones of the
    larger row, ``ceil(t * n) - 1``.
    """
    behind = F.ceil(percent * F.greatest(n, m) / 100) - 1
    return (100 + percent) * (c + behind) >= percent * (n + m)


def _share_enough(x: str, y: str, percent: int):
    """``_enough`` by the columns that each row shares with any other."""
    n, m = F.col(f"{x}n"), F.col(f"{y}n")
    c = F.least(
        _n_leading(n, percent) - F.col(f"{x}lone"), _n_leading(m, percent) - F.col(f"{y}lone")
    )
    return _enough(c, n, m, percent)


def _with_meets(rows: DataFrame, by: str, percent: int) -> DataFrame:
    """``meets``: whether the column's rows with another ``by`` leave a link possible.

    As in ``_reaches``, a row of n columns links to one of m only if m is at most the
    ``top`` of its place, and n that of the other. So the least m and the highest top of
    the others are compared; if the least is of the row's own kind, the next takes its place.
    """
    own = Window.partitionBy("column")
    top = F.floor((100 + percent) * (F.col("n") - _place()) / percent) - F.col("n")
    rows = rows.withColumn("top", top)
    rows = rows.withColumns(
        {"lo": F.min(F.struct("n", by)).over(own), "hi": F.max(F.struct("top", by)).over(own)}
    )
    below, above = (F.col(by) != F.col(f"{end}.{by}") for end in ("lo", "hi"))
    rows = rows.withColumns(
        {
            "next_lo": F.min(F.when(below, F.col("n"))).over(own),
            "next_hi": F.max(F.when(above, F.col("top"))).over(own),
        }
    )
    least = F.when(below, F.col("lo.n")).otherwise(F.col("next_lo"))
    most = F.when(above, F.col("hi.top")).otherwise(F.col("next_hi"))
    return rows.withColumn("meets", (least <= F.col("top")) & (most >= F.col("n")))


def _apart(postings: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """(entry, node, n, lone, root) of the columns that leave a link of components possible.

    The others can give no more pairs, as components only grow together.
    """
    rows = postings.select("entry", "node", "n", "lone").join(groups, "node", "left")
    rows = _by_column(rows.withColumn("root", F.coalesce("root", "node")))
    return _with_meets(rows, "root", percent).where("meets").drop("column", "top", "lo", "hi", "next_lo", "next_hi", "meets")


def _root(postings: DataFrame):
    """Its own node before the first groups."""
    return F.col("root" if "root" in postings.columns else "node")


def _pivot_pairs(postings, tested, turn, percent) -> DataFrame:
    """For each node the pivot of another component that it shares most columns with.

    Every column has one pivot: in the first turn the row with the fewest leading columns
    for itself, which of a group of similar texts is the one most like all others, and in
    later ones any. Pairs that were tested in an earlier turn are left out.
    """
    rows = _by_column(postings).withColumns({"pos": _place(), "root": _root(postings)})
    first = F.col("lone") if turn == 0 else F.lit(0)
    order = F.struct(
        first.alias("f"),
        F.xxhash64("node", F.lit(turn)).alias("o"),
        *["node", "n", "lone", "pos", "root"],
    )
    near = (
        rows.withColumn("p", F.min(order).over(Window.partitionBy("column")))
        .where((F.col("p.root") != F.col("root")) & _reaches("", "p.", percent))
        .where(_share_enough("", "p.", percent))
        .groupBy("node", F.col("p.node").alias("pivot"))
        .agg(F.count("*").alias("c"))
        .select(F.col("node").alias("a"), F.col("pivot").alias("b"), "c")
    )
    return (
        _untested(near, tested)
        .groupBy("a")
        .agg(F.max(F.struct("c", "b")).alias("best"))
        .select("a", "best.b")
    )


def _untested(pairs: DataFrame, tested: DataFrame | None) -> DataFrame:
    if tested is None:
        return pairs
    both = tested.unionByName(tested.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return pairs.join(both, ["a", "b"], "left_anti")


def _open_pairs(postings, shared, tested, percent) -> DataFrame:
    """All pairs of different components whose leading columns leave a link possible.

    A pair needs a column that may be the first it shares, and enough leading columns, the
    first block, that are the same.
    """
    rows = postings.select(
        _column().alias("column"),
        *["node", "n", "lone"],
        _place().alias("pos"),
        _root(postings).alias("root"),
    )
    x, y = (rows.select("column", *[F.col(c).alias(f"{s}{c}") for c in rows.columns[1:]]) for s in "xy")
    met = x.join(y, "column").where(
        (F.col("xnode") < F.col("ynode"))
        & (F.col("xroot") != F.col("yroot"))
        & _reaches("x", "y", percent)
        & _share_enough("x", "y", percent)
    )
    pairs = _untested(
        met.groupBy(F.col("xnode").alias("a"), F.col("ynode").alias("b")).agg(
            F.first("xn").alias("n"), F.first("yn").alias("m")
        ),
        tested,
    )
    pairs = stored(pairs, "met")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node"))
    leads = shared.join(ends, "node", "left_semi").groupBy("node")
    leads = leads.agg(F.collect_list(_column()).alias("columns"))
    counted = pairs.join(leads.toDF("a", "x"), "a").join(leads.toDF("b", "y"), "b")
    # Columns of a row that agree in their upper bits are one in the intersection.
    c = F.size(F.array_intersect("x", "y")) + F.size("x") - F.size(F.array_distinct("x"))
    return counted.where(_enough(c, F.col("n"), F.col("m"), percent)).select("a", "b")


def _verified(pairs, docs, rows, nodes, words: int, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``; stored) whose complete rows overlap enough.

    The text of each ``a`` is sent to its ``b``, and the rows are made and multiplied
    there: a text takes fewer bytes than its row of columns. A ``b`` with many ``a`` is
    sent to several places, each with about ``_PARTNERS`` of these.
    """
    places = pairs.groupBy("b").agg(F.ceil(F.count("*") / _PARTNERS).alias("places"))
    left = pairs.join(places, "b").select(
        F.col("a").alias("node"),
        F.col("b").alias("to"),
        F.pmod(F.xxhash64("a"), "places").alias("place"),
        F.lit(True).alias("partner"),
    )
    right = places.select(
        F.col("b").alias("node"),
        F.col("b").alias("to"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("places") - 1)).alias("place"),
        F.lit(False).alias("partner"),
    )
    # Stored, so that Spark knows its size and spares the texts a shuffle if it is small.
    wanted = stored(left.unionByName(right).join(nodes.select("node", "mark"), "node"), "wanted")
    texts = _maybe_marked(docs, wanted).select("mark", "text")
    # Made unique, which may shuffle the texts, only if a wanted row is repeated as a whole.
    repeated = rows.join(wanted, "mark", "left_semi").groupBy("mark").count().where("count > 1")
    if not repeated.isEmpty():
        texts = texts.dropDuplicates(["mark"])
    met = (
        texts.join(wanted, "mark")
        .select("to", "place", "partner", "node", "text")
        .repartition("to", "place")
        .sortWithinPartitions("to", "place", "partner")
    )
    return met.mapInArrow(_overlap_task(words, percent), "a long, b long")


def _maybe_marked(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``docs`` without most rows whose mark is not among the wanted ones.

    Marks set bits of a map of 1 to 8 MB, which is broadcast; a row with a wanted mark
    always stays. The texts of the others are not shuffled.
    """
    bits, most = _MARK_BITS
    enough = 8 * wanted.count()
    while bits < min(enough, most):
        bits *= 2
    bit = F.pmod("mark", F.lit(bits))
    row, at = F.shiftright(bit, 15).alias("__row"), F.pmod(bit, F.lit(1 << 15))
    maps = wanted.select(row, at.alias("at")).groupBy("__row").agg(
        F.bitmap_construct_agg("at").alias("__map")
    )
    byte = F.substring("__map", F.floor(at / 8).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    is_set = F.floor(value / F.pow(F.lit(2), F.pmod(at, F.lit(8)))) % 2 == 1
    found = docs.withColumn("__row", row).join(F.broadcast(maps), "__row").where(is_set)
    return found.select(*docs.columns)


# Tasks: numpy over Arrow batches.


def _sets_of(data: np.ndarray, offsets: np.ndarray, words: int, hasher) -> Iterator:
    """The sorted n-gram hashes of each text."""
    data = _text.lower_ascii(data)
    found = _text.split_words(data, offsets)
    hashes = hasher.ranges(data, found.start, found.end)
    grams, at = hasher.windows(hashes, found.first, words)
    begin = np.searchsorted(at, found.first)
    for i in range(len(offsets) - 1):
        own = grams[begin[i] : begin[i + 1]]
        if len(own) == 0:
            few = hashes[found.first[i] : found.first[i + 1]]
            if len(few):
                mixed = (few * hasher.steps[: len(few)]).sum(dtype=np.uint64)
                own = _text.scramble(np.array([mixed + np.uint64(len(few))]))
        yield np.unique(own)


def _node(own: np.ndarray) -> int:
    total = _text.scramble(own ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(_text.scramble(np.array([total + np.uint64(len(own))])).view(np.int64)[0])


def _frequencies(docs: DataFrame, words: int) -> np.ndarray:
    """About how often each n-gram occurs, by a hash of it, as a rank of one byte.

    Any order of the columns gives right results; the sketch makes it a good one. Ranks
    grow with the logarithm of the counts above their mean.
    """
    counters, pieces = COUNTERS, _PIECES
    shift = np.uint64(64 - counters.bit_length() + 1)

    def batch_of(numbers, parts):
        return pa.RecordBatch.from_pydict(
            {
                "piece": pa.array(numbers, pa.int32()),
                "counts": pa.array(parts, pa.binary()),
            }
        )

    def count(batches):
        hasher = _text.Hasher()
        counts = np.zeros(counters, np.uint8)
        for batch in batches:
            for _, data, offsets in _text.slices(batch, "text"):
                for own in _sets_of(data, offsets, words, hasher):
                    at = own >> shift
                    # A counter stays at its highest value.
                    counts[at] += counts[at] < 255
        # Most are small, which the codec of the shuffle makes little of.
        packed = [pa.compress(p, codec="zstd") for p in counts.reshape(pieces, -1)]
        yield batch_of(range(pieces), [p.to_pybytes() for p in packed])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, counts in zip(*batch.columns, strict=True):
                new = pa.decompress(counts.as_buffer(), counters // pieces, "zstd")
                new = np.frombuffer(new, np.uint8)
                number = piece.as_py()
                if number not in sums:
                    sums[number] = np.zeros(len(new), np.int64)
                sums[number] += new
        # The mean of a piece is that of all, but for chance.
        ranks = [
            np.minimum(255, 24 * np.log2(1 + np.maximum(v - v.mean(), 0))).astype(np.uint8).tobytes()
            for v in sums.values()
        ]
        yield batch_of(list(sums), ranks)

    schema = "piece int, counts binary"
    summed = (
        docs.select("text")
        .mapInArrow(count, schema)
        .repartition(pieces, "piece")
        .mapInArrow(add, schema)
    )
    out = np.zeros((pieces, counters // pieces), np.uint8)
    for row in summed.collect():
        out[row.piece] = np.frombuffer(row.counts, np.uint8)
    return out.reshape(-1)


def _rows(docs: DataFrame, words: int) -> DataFrame:
    """(key, mark, node, n): the number of columns and a hash of all of them."""

    def make(batches):
        hasher = _text.Hasher()
        for batch in batches:
            for part, data, offsets in _text.slices(batch, "text"):
                sets = list(_sets_of(data, offsets, words, hasher))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array([_node(s) if len(s) else None for s in sets], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                    ],
                    ["key", "mark", "node", "n"],
                )

    kind = docs.schema["key"].dataType.simpleString()
    return docs.mapInArrow(make, f"key {kind}, mark long, node long, n long")


def _leading(docs: DataFrame, words: int, percent: int, rank: np.ndarray) -> DataFrame:
    """(node, n, leading): entries of each text's columns that come first in the common order."""
    ranks = docs.sparkSession.sparkContext.broadcast(rank)
    shift = np.uint64(64 - len(rank).bit_length() + 1)

    def lead(batches):
        hasher = _text.Hasher()
        seen: set[int] = set()
        for batch in batches:
            for _, data, offsets in _text.slices(batch, "text"):
                sets = {_node(s): s for s in _sets_of(data, offsets, words, hasher) if len(s)}
                # Copies of a text within a task count once.
                sets = {node: s for node, s in sets.items() if node not in seen}
                seen.update(sets)
                leads = [
                    _entries(
                        own[np.argsort(ranks.value[own >> shift], kind="stable")][
                            : len(own) - (percent * len(own) + 99) // 100 + 1
                        ]
                    )
                    for own in sets.values()
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(sets), pa.int64()),
                        pa.array([len(s) for s in sets.values()], pa.int64()),
                        _lists(leads),
                    ],
                    ["node", "n", "leading"],
                )

    return docs.mapInArrow(lead, "node long, n long, leading array<long>")


def _entries(leading: np.ndarray) -> np.ndarray:
    """The columns' upper bits and their places; the last place is that of all behind it."""
    places = np.minimum(np.arange(len(leading)), _LAST_PLACE).astype(np.uint64)
    return leading & ~np.uint64(_LAST_PLACE) | places


def _overlap_task(words: int, percent: int):
    """Links between each row that is no partner and the partners behind it."""

    def run(batches):
        hasher = _text.Hasher()
        here, row = None, None
        for batch in batches:
            for part, data, offsets in _text.slices(batch, "text"):
                places = part.select(["to", "place", "partner", "node"]).to_pylist()
                linked = []
                for at, own in zip(places, _sets_of(data, offsets, words, hasher), strict=True):
                    if not at["partner"]:
                        here, row = (at["to"], at["place"]), own
                        continue
                    if here != (at["to"], at["place"]):
                        raise ValueError("a partner without its row")
                    overlap = len(np.intersect1d(row, own, assume_unique=True))
                    # 100 * overlap >= percent * (n + m - overlap)
                    if (100 + percent) * overlap >= percent * (len(row) + len(own)):
                        linked.append((at["node"], at["to"]))
                a, b = zip(*linked) if linked else ((), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
                )

    return run


def _lists(sets: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, sets)])
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))
