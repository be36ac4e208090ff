"""Exact Jaccard join on word shingles by prefix filters under several orders.

Two sets with Jaccard similarity t or more share a token within their prefixes
(1 - t of each set, and one more) under *any* global order of all tokens.  So a
pair has to pass under several orders before it is verified:

1. by hash, ascending: a document stays only if enough tokens of its (slightly
   longer) prefix are also in the prefix of a different set;
2. by document frequency, rare first, among those: pairs come from this order;
3. by hash, ascending and descending: of the pairs that are left after the rounds
   below, only those whose prefixes meet under both have their sets compared.

Equal sets form one class, named by its digest, with one representative row, so
copies are never paired.  Rows are told apart by a hash of id and text (ids may
be null or repeated); rows equal in both are the same document.
Components only need enough links to hold together: a document is first compared
with the hub of its token lists, then with the middle of the component it meets
most (as many pairs as documents); then all pairs across components that are
left, and that their measures against a common middle do not rule out, are
compared, so no link between components is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import common
from quarry.llm.common import written
from quarry.session import scratch_path, unique_name

WORDS = 5
PERCENT = 75
STAR_ROUNDS = 2
#: Texts of the scans are taken in slices of so many bytes, from batches of so many rows.
SCAN_BYTES = 1 << 18
SCAN_ROWS = 2000
_FACTORS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD]


def _least_overlap(n):
    """Tokens that a set of n has in common with any similar one, at least."""
    return (PERCENT * n + 99) // 100


def _extra(n):
    """Common tokens asked of the longer prefixes in the first filter."""
    return 1 + n // 8


def _prefix(n, extra=1):
    return n - _least_overlap(n) + extra


def shingle_sets(data: np.ndarray, offsets: np.ndarray, hasher=common.WordHasher()) -> list[np.ndarray]:
    """The sorted distinct shingle hashes (int64) of each text."""
    words, _, bounds = hasher(data, offsets)
    n = len(words)
    if n >= WORDS:
        rolled = np.zeros(n - WORDS + 1, np.uint64)
        for k in range(WORDS):
            rolled += words[k: n - WORDS + 1 + k] * np.uint64(_FACTORS[k])
        rolled = common.mixed(rolled).view(np.int64)
    sets = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= WORDS:
            sets.append(np.unique(rolled[a: b - WORDS + 1]))
        elif b > a:  # the whole sequence is one shingle
            h = np.array([b - a], np.uint64)
            for k, w in enumerate(words[a:b, None]):
                h = h + common.mixed(w * np.uint64(_FACTORS[k])) * np.uint64(_FACTORS[-1 - k])
            sets.append(common.mixed(h).view(np.int64))
        else:
            sets.append(np.zeros(0, np.int64))
    return sets


def signature(s: np.ndarray) -> int:
    """A 64-bit digest of a sorted set (used together with its size)."""
    if not len(s):
        return 0
    u = s.view(np.uint64)
    with np.errstate(over="ignore"):
        h = (common.mixed(u) * np.uint64(_FACTORS[1]) + u * np.uint64(_FACTORS[2])).sum(dtype=np.uint64)
    return int(common.mixed(np.array([h + np.uint64(len(s))], np.uint64)).view(np.int64)[0])


def _list_array(parts: list[np.ndarray]) -> pa.Array:
    at = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=at[1:])
    values = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values, pa.int64()))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def row_key(doc_id: Column, text: Column) -> Column:
    """A hash of a row's id and text, the same in every run."""
    return F.xxhash64(doc_id.cast("long"), F.coalesce(text.cast("string"), F.lit("")))


def with_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n, sig) per document: size and digest of its set."""
    return _scanned(docs, "doc_id long, key long, n long, sig long")


def with_heads(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n, sig, head) per document: size and digest of its set, and
    the longer prefix in ascending order of hashes."""
    return _scanned(docs, "doc_id long, key long, n long, sig long, head array<long>")


def _scanned(docs: DataFrame, schema: str) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]

    def rows(batches):
        for part in common.slices(batches, "text", SCAN_BYTES):
            sets = shingle_sets(*common.buffers_of(common.text_column(part, "text")))
            columns = [part.column(0), part.column(2), pa.array([len(s) for s in sets], pa.int64()),
                       pa.array([signature(s) for s in sets], pa.int64())]
            if "head" in names:
                columns.append(_list_array([s[: _prefix(len(s), _extra(len(s)))] if len(s) else s for s in sets]))
            del sets
            yield pa.RecordBatch.from_arrays(columns, names=names)
            del columns
            pa.default_memory_pool().release_unused()

    keyed = _texts(docs).withColumn("key", row_key(F.col("doc_id"), F.col("text")))
    return keyed.mapInArrow(rows, schema)


def alive(slim: DataFrame, heads: DataFrame, classes: DataFrame) -> DataFrame:
    """Classes (sig, n, row) that pass the first filter."""
    copies = slim.select("key", "sig", "n").join(classes, ["sig", "n"]).where("key <> row").select("key")
    copies = written(copies.distinct(), "jaccard_copies")
    lists = heads.join(copies, "key", "left_anti").select("sig", F.explode("head").alias("token"))
    hot = common.heavy(lists, "token")
    is_hot = F.col("token").isin(hot) if hot else F.lit(False)
    bounds = lists.where(~is_hot).withColumns({"_a": F.min("sig").over(_by("token")), "_b": F.max("sig").over(_by("token"))})
    shared = bounds.where("_a <> _b").select("sig")
    if hot:  # their rows stay where they are
        of_two = lists.where(is_hot).groupBy("token").agg(F.min("sig").alias("_a"), F.max("sig").alias("_b")).where("_a <> _b")
        shared = shared.unionByName(lists.where(is_hot).join(F.broadcast(of_two.select("token")), "token").select("sig"))
    met = shared.groupBy("sig").agg(F.count("*").alias("met"))
    # the partner may be smaller, by a quarter at most
    need = 1 + F.floor(F.floor((PERCENT * F.col("n") + 99) / 100) / 8)
    return classes.join(met, "sig").where(F.col("met") >= need).select("sig", "n", "row")


def _by(*keys):
    from pyspark.sql import Window

    return Window.partitionBy(*keys)


def sets_of(docs: DataFrame, living: DataFrame) -> DataFrame:
    """(rep, n, set) of the living classes, from their representatives' texts (more than
    once for repeated rows); ``rep`` is the digest that names a class.

    A bitmap of the row keys (of fixed size) keeps most other texts out of the join.
    The join moves them, however few: with a broadcast both Python functions were
    in one task, and an executor would keep two workers for each of its cores.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << common.BITMAP_BITS)).cast("int")
    bits = common.bitmap(living.select(place(F.col("row"))))
    rows = _texts(docs).withColumn("key", row_key(F.col("doc_id"), F.col("text")))
    rows = rows.select(place(F.col("key")).alias("place"), "key", "text")

    def chosen(batches):
        for batch in batches:
            keep = common.in_bitmap(bits, batch.column(0).to_numpy())
            yield batch.select([1, 2]).filter(pa.array(keep))

    rows = rows.mapInArrow(chosen, "key long, text string")
    living = living.select("row", F.col("sig").alias("rep")).hint("shuffle_hash")
    rows = rows.join(living, F.col("key") == F.col("row")).select("rep", "text")

    def sets(batches):
        for part in common.slices(batches, "text"):
            found = shingle_sets(*common.buffers_of(common.text_column(part, "text")))
            wanted = part.column(0).to_pylist()
            same = [k for k, s in enumerate(found) if signature(s) == wanted[k]]
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(same, pa.int64())), pa.array([len(found[k]) for k in same], pa.int64()),
                 _list_array([found[k] for k in same])], names=["rep", "n", "set"])

    return rows.mapInArrow(sets, "rep long, n long, set array<long>")


def bucketed(sets: DataFrame) -> tuple[str, DataFrame]:
    """``sets`` as a table (its name, and itself) in buckets of ``rep``: the joins of
    every round find the sets where they lie and move only pairs."""
    spark = sets.sparkSession
    name = unique_name("jaccard_sets")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with common.python_batches(spark, SCAN_ROWS):
        # rows equal in id and text give one set each; they meet in the bucket's task
        sets.repartition(n, "rep").dropDuplicates(["rep"]).write.bucketBy(n, "rep").option("path", scratch_path(spark, "llm/sets")).saveAsTable(name)
    return name, spark.table(name)


def prefix_lists(sets: DataFrame) -> DataFrame:
    """(token, rep, n, at, size, middle): prefixes in order of document frequency.

    Tokens of one set only come first and meet nothing; ``at`` counts the others
    before a token, ``size`` is their number.  ``middle`` tells how much of a set
    others share: among copies with edits it is greatest for their original.
    """
    tokens = sets.select("rep", "n", F.explode("set").alias("token"))
    hot = common.heavy(tokens, "token")
    is_hot = F.col("token").isin(hot) if hot else F.lit(False)
    shared = tokens.where(~is_hot).withColumn("df", F.count("*").over(_by("token"))).where("df > 1")
    if hot:  # counted without being gathered
        counts = tokens.where(is_hot).groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
        shared = shared.unionByName(tokens.where(is_hot).join(F.broadcast(counts), "token").select("rep", "n", "token", "df"))
    ordered = shared.groupBy("rep", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("_t"), (F.sum(F.log2("df")) / F.col("n")).alias("middle"))
    ordered = ordered.withColumn("size", F.size("_t").cast("long"))
    places = F.col("n") - F.floor((PERCENT * F.col("n") + 99) / 100) + 1 - (F.col("n") - F.col("size"))
    ordered = ordered.withColumn("_k", places.cast("int")).where("_k > 0")
    return ordered.select("rep", "n", "size", "middle", F.posexplode(F.slice("_t", F.lit(1), F.col("_k"))).alias("at", "_x")).select(
        F.col("_x.token").alias("token"), "rep", "n", "at", "size", "middle")


MEASURED = "a long, b long, similar boolean, shared long, other0 long, other1 long, other2 long, other3 long, folded long"


def measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of representatives with ``similar`` (they share tokens of
    both hash-ordered prefixes, and then enough tokens), ``shared`` (common
    tokens), and a's other tokens as 256 bits; ``folded`` counts those that found
    their bit taken."""
    left = sets.select(F.col("rep").alias("a"), F.col("set").alias("x"))
    right = sets.select(F.col("rep").alias("b"), F.col("set").alias("y"))
    # a hub that many meet: its few sets are repeated, so that its pairs are dealt out
    counts = pairs.groupBy("b").agg(F.count("*").alias("n"))
    total = pairs.count()
    hot = [r["b"] for r in counts.where(F.col("n") * common.HOT_KEYS > total).where(F.col("n") > 1).select("b").collect()]
    is_hot = F.col("b").isin(hot) if hot else F.lit(False)
    both = pairs.where(~is_hot).select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y")
    if hot:
        some = pairs.where(is_hot).select("a", "b").join(left, "a")
        both = both.unionByName(common.salted_join(some, right.where(is_hot), "b", hot, "a").select("a", "b", "x", "y"))

    def measure(batches):
        for batch in batches:
            rows = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.asarray(x.values), np.asarray(y.values)
                others = np.setdiff1d(x, y, assume_unique=True)
                bits = np.unique(others & 255)
                words = [int(np.bitwise_or.reduce(np.uint64(1) << (bits[bits >> 6 == k] & 63).astype(np.uint64), initial=0).view(np.int64))
                         for k in range(4)]
                rows.append((similar_sets(x, y), len(x) - len(others), *words, len(others) - len(bits)))
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(columns[0], pa.bool_()), *[pa.array(c, pa.int64()) for c in columns[1:]]],
                names=[c.split()[0] for c in MEASURED.split(", ")])

    return both.mapInArrow(measure, MEASURED)


def may_reach(one: str, other: str) -> Column:
    """Whether two sets can have enough tokens in common, as far as their
    measures against the same third set tell (true if there are none).

    Common tokens lie in the third set, at most ``shared`` of either, or outside,
    at most as many as their bits have in common and folded ones.
    """
    c = lambda name, side: F.col(name + side)
    bits = sum((F.bit_count(c(f"other{k}", one).bitwiseAND(c(f"other{k}", other))) for k in range(4)), F.lit(0))
    most = F.least(c("shared", one), c("shared", other)) + bits + F.least(c("folded", one), c("folded", other))
    reach = (100 + PERCENT) * most >= PERCENT * (c("n", one) + c("n", other))
    return F.coalesce((c("hub", one) != c("hub", other)) | reach, F.lit(True))


def similar_sets(x: np.ndarray, y: np.ndarray) -> bool:
    n, m = len(x), len(y)
    if PERCENT * max(n, m) > 100 * min(n, m):
        return False
    p, q = _prefix(n), _prefix(m)
    for one, other in ((x[:p], y[:q]), (x[n - p:], y[m - q:])):
        if not len(np.intersect1d(one, other, assume_unique=True)):
            return False
    common_tokens = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common_tokens >= PERCENT * (n + m - common_tokens)


def under_hash_orders(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that share a token in their prefixes under ascending and under
    descending order of hashes, too; only prefixes are compared."""
    size = (F.col("n") - F.floor((PERCENT * F.col("n") + 99) / 100) + 1).cast("int")
    ends = lambda side: sets.select(
        F.col("rep").alias(side), F.slice("set", F.lit(1), size).alias(f"low_{side}"),
        F.slice("set", F.col("n").cast("int") - size + 1, size).alias(f"high_{side}"))
    both = pairs.select("a", "b").join(ends("a"), "a").join(ends("b"), "b")
    return both.where(F.arrays_overlap("low_a", "low_b") & F.arrays_overlap("high_a", "high_b")).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable, for every node of ``links``.

    Labels go to neighbours and then jump along labels; every step is written,
    and ends when no label changes.
    """
    edges = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "jaccard_edges")
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "jaccard_labels")
    while True:
        near = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("comp").alias("_near"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", F.least("comp", "_near").alias("_to"), "comp")
        target = labels.select(F.col("node").alias("_n"), F.col("comp").alias("_jump"))
        jumped = step.join(target, F.col("_to") == F.col("_n"), "left").select(
            "node", F.least("_to", "_jump").alias("comp"), (F.least("_to", "_jump") < F.col("comp")).alias("_moved"))
        new = written(jumped, "jaccard_labels")
        moved = new.where("_moved").limit(1).count()
        labels = new.select("node", "comp")
        if not moved:
            return labels


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (rep, comp) after more links between representatives."""
    a = labels.select(F.col("rep").alias("a"), F.col("comp").alias("_ca"))
    b = labels.select(F.col("rep").alias("b"), F.col("comp").alias("_cb"))
    between = links.join(a, "a").join(b, "b").where("_ca <> _cb").select(F.col("_ca").alias("a"), F.col("_cb").alias("b"))
    found = components(between).withColumnRenamed("comp", "_new")
    out = labels.join(found, labels["comp"] == found["node"], "left")
    return written(out.select("rep", F.coalesce("_new", "comp").alias("comp")), "jaccard_components")


def linked_components(lists: DataFrame, sets: DataFrame) -> DataFrame:
    """(rep, comp) over all links of the sets."""
    hot = common.heavy(lists, "token")
    labels = written(sets.select("rep", F.col("rep").alias("comp")), "jaccard_components")
    measures = None
    for choose in (list_hubs, centers)[:STAR_ROUNDS]:
        rows = lists.select("token", "rep", "n", "middle").join(labels, "rep")
        measures = written(measured(written(choose(rows, hot), "jaccard_star"), sets), "jaccard_links")
        labels = merged(labels, measures.where("similar"))
    if measures:
        measures = measures.drop("similar").withColumnsRenamed({"a": "rep", "b": "hub"})
    rows = lists.drop("middle").join(labels, "rep")
    mixed_lists = rows.groupBy("token").agg(F.min("comp").alias("_a"), F.max("comp").alias("_b")).where("_a <> _b").select("token")
    rows = common.salted_join(rows, mixed_lists, "token", hot, "rep")
    told = ["hub", "shared", "other0", "other1", "other2", "other3", "folded"]
    rows = rows.join(measures, "rep", "left") if measures else rows.withColumns({c: F.lit(None).cast("long") for c in told})
    rows = written(rows, "jaccard_rest")
    one, other = (rows.select("token", *[F.col(c).alias(c + side) for c in ("rep", "n", "at", "size", "comp", *told)]) for side in ("1", "2"))
    # what the first common token of a pair leaves of both sets; later ones may miss it
    most = F.least(F.col("size1") - F.col("at1"), F.col("size2") - F.col("at2"))
    pairs = common.salted_join(one, other, "token", hot, "rep1").where(
        (F.col("rep1") < F.col("rep2")) & (F.col("comp1") != F.col("comp2")) & _sizes_fit(F.col("n1"), F.col("n2"))
        & ((100 + PERCENT) * most >= PERCENT * (F.col("n1") + F.col("n2"))) & may_reach("1", "2"))
    pairs = pairs.select(F.col("rep1").alias("a"), F.col("rep2").alias("b")).distinct()
    pairs = written(under_hash_orders(written(pairs, "jaccard_pairs"), sets), "jaccard_filtered")
    return merged(labels, written(measured(pairs, sets), "jaccard_links").where("similar"))


def _hub_of_list(rows: DataFrame) -> DataFrame:
    """Per token, its row of greatest ``middle``, and whether components differ."""
    hubs = rows.groupBy("token").agg((F.min("comp") != F.max("comp")).alias("_mixed"),
                                     F.max(F.struct("middle", "rep", "comp", "n")).alias("_h"))
    return hubs.select("token", "_mixed", F.col("_h.rep").alias("hub"), F.col("_h.comp").alias("_hc"), F.col("_h.n").alias("_hn"))


def list_hubs(rows: DataFrame, hot: list[int]) -> DataFrame:
    """(a, b): each representative with the hub, of another component, that it
    meets in most lists."""
    near = common.salted_join(rows, _hub_of_list(rows).where("_mixed"), "token", hot, "rep").where(
        (F.col("comp") != F.col("_hc")) & _sizes_fit(F.col("n"), F.col("_hn")))
    return near.groupBy("rep", "hub").agg(F.count("*").alias("_c")).groupBy("rep").agg(
        F.max(F.struct("_c", "hub")).alias("_h")).select(F.col("rep").alias("a"), F.col("_h.hub").alias("b"))


def centers(rows: DataFrame, hot: list[int]) -> DataFrame:
    """(a, b): each representative with the middle of the component that it
    meets in most lists, its own or another."""
    middles = rows.groupBy("comp").agg(F.max(F.struct("middle", "rep")).alias("_m")).select(
        F.col("comp").alias("_hc"), F.col("_m.rep").alias("b"))
    met = common.salted_join(rows, _hub_of_list(rows), "token", hot, "rep").groupBy("rep", "_hc").agg(F.count("*").alias("_c"))
    best = met.groupBy("rep").agg(F.max(F.struct("_c", "_hc")).alias("_h")).select(F.col("rep").alias("a"), F.col("_h._hc").alias("_hc"))
    return best.join(middles, "_hc").where("a <> b").select("a", "b")


def _sizes_fit(n: Column, m: Column) -> Column:
    return PERCENT * F.greatest(n, m) <= 100 * F.least(n, m)


def row_components(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n_shingles, node, component_id) per row of ``docs``: ``node``
    tells components apart, also those with the same smallest id or without ids;
    it is null for empty sets."""
    common.ship(docs.sparkSession)
    slim = written(with_digests(docs), "jaccard_digests", SCAN_ROWS)
    classes = written(slim.where("n > 0").groupBy("sig", "n").agg(F.min("doc_id").alias("least"), F.min("key").alias("row")),
                      "jaccard_classes")
    # the prefixes, most of a document's bytes, are made again from the texts where they are used
    with common.python_batches(docs.sparkSession, SCAN_ROWS):
        living = written(alive(slim, with_heads(docs), classes), "jaccard_alive")
    name, sets = bucketed(sets_of(docs, living))
    lists = written(prefix_lists(sets), "jaccard_lists")
    labels = linked_components(lists, sets).withColumnRenamed("rep", "sig")
    sets.sparkSession.sql(f"DROP TABLE {name}")  # all that follows is written
    names = labels.join(classes, "sig").groupBy("comp").agg(F.min("least").alias("name"))
    named = classes.join(labels.join(names, "comp"), "sig", "left").select(
        "sig", "n", F.coalesce("comp", "sig").alias("node"), F.coalesce("name", "least").alias("component_id"))
    # empty sets (a hot key of no use) do not take part in the join
    full = slim.where("n > 0").join(named, ["sig", "n"]).select(
        "doc_id", "key", F.col("n").alias("n_shingles"), "node", "component_id")
    empty = slim.where("n = 0").select("doc_id", "key", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("node"),
                                       F.col("doc_id").alias("component_id"))
    return full.unionByName(empty)


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs`` (doc_id, text).

    A document's set holds its distinct shingles of five words (A-Z lower-cased,
    words without white space); with fewer words, the whole sequence.  Documents
    link at a Jaccard similarity of 0.75; component_id is the smallest doc_id
    reachable.  Null and empty texts have an empty set, link with nothing and
    keep their own id; repeated rows are copies; rows that share an id have each
    the component of their own text; rows with a null id link as others, but name
    none (null if no row with an id is reachable).  Other columns are not read.
    """
    return row_components(docs).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per component: that of the smallest doc_id (null last),
    then row key.  Of rows equal in id and text one stays, by a hash of the whole
    row.  Rows with neither id nor words are no copies of each other and stay."""
    own = docs.columns
    found = written(row_components(docs).select("doc_id", "key", "node"), "duplicate_rows")
    linked = found.where("node is not null")
    first = linked.groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("_nil"), "doc_id", "key")).alias("_f"))
    gone = written(linked.select("key").distinct().join(first.select(F.col("_f.key").alias("key")), "key", "left_anti")
                   .withColumnRenamed("key", "_gone"), "duplicates")
    repeats = found.where("node is not null or doc_id is not null").groupBy("key").count().where("count > 1")
    repeats = written(repeats.join(gone, repeats["key"] == gone["_gone"], "left_anti").select(F.col("key").alias("_again")), "repeats")
    keyed = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("_row_key"), F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row"))
    keyed = keyed.join(gone, keyed["_row_key"] == gone["_gone"], "left_anti")
    single = keyed.join(repeats, keyed["_row_key"] == repeats["_again"], "left_anti").select("_row.*")
    if repeats.isEmpty():
        return single
    hashed = [F.col("_row")[f.name] for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    again = keyed.join(repeats, keyed["_row_key"] == repeats["_again"], "left_semi")
    again = again.groupBy("_row_key").agg(F.min_by("_row", F.xxhash64(*hashed)).alias("_row"))
    return single.unionByName(again.select("_row.*"))
