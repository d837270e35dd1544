"""Near-duplicates by MinHash signatures, joined through their coordinates.

A document's set holds its distinct five-word runs. Documents with equal sets are one class. A class is posted under
each of its signature's coordinate-value pairs. Two sets that are similar enough agree in a number of coordinates, so of
each class only the rarest pairs have to be looked at (the prefix); pairs that nobody shares are skipped altogether. In a
posting list the members are compared with pivots only, turn by turn, and each with the few that it meets in most lists.
What these comparisons connect is one component, and lists within one component are skipped from then on. Once the pivots
find little more, all members of different components that are left in a list are compared with each other, as far as
they share one of the rarest runs of their whole sets; so pivots decide on the work, not on the result. Candidates must
agree in enough coordinates and are then confirmed on their whole sets.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from admitflow.llm.common import stored
from admitflow.llm.wordhash import mix, run_hashes, word_hashes

SHINGLE_WORDS = 5
LEAST_PERCENT = 75
# Of 64 coordinates a pair of similarity 0.75 agrees in fewer than 34 about three times in 100,000, more similar ones
# hardly ever. The higher the threshold, the shorter the prefix: what a third of the text shares is then not posted.
COORDINATES = 64
LEAST_MATCHES = 34
# Pivots that a member is compared with in one turn: those it meets in most lists.
PIVOTS_A_TURN = 3
# A turn that finds fewer links is the last one with pivots.
FEW_LINKS = 100
# Bytes of text that one pass over arrays holds.
PASS_BYTES = 1 << 22

_SEEDS = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)) | np.uint64(1)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct hashes of the five-word runs of each text in lower case (A-Z only).

    A text with fewer words has one run, the whole; one without words has none.
    """
    words, counts = word_hashes([t.lower() for t in texts])
    runs = run_hashes(words, SHINGLE_WORDS)
    sets, at = [], 0
    for n in counts.tolist():
        if n >= SHINGLE_WORDS:
            sets.append(np.unique(runs[at : at + n - SHINGLE_WORDS + 1]))
        elif n:
            sets.append(run_hashes(words[at : at + n], n) ^ np.uint64(n))
        else:
            sets.append(np.empty(0, np.uint64))
        at += n
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The smallest of each coordinate's hash over each set; sets must not be empty."""
    sizes = np.array([len(s) for s in sets])
    joined, first = np.concatenate(sets), np.cumsum(sizes) - sizes
    columns = [np.minimum.reduceat((joined * seed) >> np.uint64(33), first) for seed in _SEEDS]
    return np.stack(columns, axis=1).astype(np.int32)


def _passes(batch: pa.RecordBatch) -> Iterator[tuple[list, list[bytes]]]:
    ids, texts, held = [], [], 0
    for doc_id, text in zip(batch.column(0), batch.column(1)):
        ids.append(doc_id.as_py())
        texts.append((text.as_py() or "").encode())
        held += len(texts[-1])
        if held >= PASS_BYTES:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, texts in _passes(batch):
            sets = shingle_sets(texts)
            keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            some = [s for s in sets if len(s)]
            signed = iter(signatures(some).tolist() if some else [])
            columns = [
                pa.array(ids, pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(keys, pa.binary()),
                pa.array([next(signed) if len(s) else None for s in sets], pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "key", "signature"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, texts in _passes(batch):
            sets = [s.tobytes() for s in shingle_sets(texts)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], ["id", "set"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = []
        for x, y in zip(batch.column(2), batch.column(3)):
            x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
            common = len(np.intersect1d(x, y, assume_unique=True))
            good.append(100 * common >= LEAST_PERCENT * (len(x) + len(y) - common))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(good)], ["a", "b", "good"])


def _posted(classes: DataFrame) -> DataFrame:
    """(coordinate, value, id): every class under the rarest of its shared pairs, as many as a match cannot avoid."""
    pairs = classes.select("id", F.posexplode("signature").alias("coordinate", "value"))
    often = pairs.groupBy("coordinate", "value").agg(F.count("*").alias("n")).where("n > 1")
    shared = pairs.join(often, ["coordinate", "value"])
    rarest = Window.partitionBy("id").orderBy("n", "coordinate")
    ranked = shared.select(
        "*", F.row_number().over(rarest).alias("place"), F.count("*").over(Window.partitionBy("id")).alias("shared")
    )
    return ranked.where(F.col("place") <= F.col("shared") - (LEAST_MATCHES - 1)).select("coordinate", "value", "id")


# Bits that stand for ids among which texts are looked for: some per id, so many at most (8 MB).
_BITS_PER_ID = 16
_MOST_BITS = 1 << 26
# Bits that one row of Spark's bitmaps holds.
_ROW_BITS = 1 << 15


def _likely(rows: DataFrame, ids: DataFrame, name: str = "doc_id") -> DataFrame:
    """The ``rows`` whose column ``name`` may be among ``ids`` (id); none that is goes missing.

    Ids set bits of a map by their hash. It is bounded and broadcast, so rows that are surely not wanted are dropped
    where they are read, and a join that follows shuffles few others.
    """
    bits = min(_MOST_BITS, max(_ROW_BITS, 1 << (_BITS_PER_ID * ids.count()).bit_length()))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    row, bit = (lambda c: F.floor(place(c) / _ROW_BITS)), (lambda c: F.pmod(place(c), F.lit(_ROW_BITS)))
    maps = ids.groupBy(row("id").alias("__row")).agg(F.bitmap_construct_agg(bit("id")).alias("__bits"))
    byte = F.substring("__bits", F.floor(bit(name) / 8).cast("int") + 1, F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(bit(name), F.lit(8)).cast("int")) == 1
    found = rows.join(F.broadcast(maps), (row(name) == F.col("__row")) & is_set)
    return found.select(*rows.columns)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()


def _agreeing(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose sizes allow the similarity and whose signatures agree in enough coordinates."""
    wanted = _likely(classes, _ends(pairs), "id")
    side = lambda name: wanted.select(
        F.col("id").alias(name), F.col("signature").alias(f"s{name}"), F.col("size").alias(f"n{name}")
    )
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    both = both.where(100 * F.least("na", "nb") >= LEAST_PERCENT * F.greatest("na", "nb"))
    equal = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda e: e))
    return both.where(equal >= LEAST_MATCHES).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that are similar on their whole sets. Sets of no pair are left where they are read."""
    wanted = _likely(sets, _ends(pairs), "id")
    side = lambda name: wanted.select(F.col("id").alias(name), F.col("set").alias(f"s{name}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb")
    return both.mapInArrow(_confirm, "a long, b long, good boolean").where("good").select("a", "b")


def _roots(edges: DataFrame) -> DataFrame:
    """(id, root) of every id in ``edges``: each follows its smallest neighbour down, as long as one is smaller."""
    both = edges.select("a", "b").union(edges.select("b", "a"))
    roots = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "roots")
    while True:
        further = roots.select(F.col("id").alias("root"), F.col("root").alias("further"))
        moved = (F.col("further") < F.col("root")).alias("moved")
        jumped = stored(roots.join(further, "root").select("id", F.col("further").alias("root"), moved), "roots")
        roots = jumped.select("id", "root")
        if not jumped.where("moved").limit(1).count():
            return roots


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b; two ids each): the smallest id reachable.

    In each round every id becomes one with its root, and only links between different roots are left for the next. A
    root takes at least one neighbour in, so the ids left are halved, and links within a large group are read but once.
    The tables are written after each round, so a lost executor costs one round at most.
    """
    edges, labels = stored(_ordered(links, "a", "b"), "edges"), None
    while True:
        roots = _roots(edges)
        if labels is None:
            labels = roots.withColumnRenamed("root", "component")
        else:
            later = roots.select(F.col("id").alias("component"), F.col("root"))
            moved = labels.join(later, "component", "left")
            labels = stored(moved.select("id", F.coalesce("root", "component").alias("component")), "labels")
        side = lambda end: roots.select(F.col("id").alias(end), F.col("root").alias(f"r{end}"))
        between = edges.join(side("a"), "a").join(side("b"), "b").where("ra <> rb")
        edges = stored(_ordered(between, "ra", "rb"), "edges")
        if not edges.limit(1).count():
            return labels


def _ordered(pairs: DataFrame, x: str, y: str) -> DataFrame:
    return pairs.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def _open(members: DataFrame, *keys: str) -> DataFrame:
    """Members of the lists (``keys``) that still hold different components."""
    lists = members.groupBy(*keys).agg(F.min("component").alias("least"), F.max("component").alias("most"))
    return members.join(lists.where("least < most").drop("least", "most"), list(keys))


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for *fixed, value in zip(*batch.columns):
            hashes = np.frombuffer(value.as_py(), np.int64)
            same = [pa.array(np.full(len(hashes), v.as_py())) for v in fixed]
            yield pa.RecordBatch.from_arrays([*same, pa.array(hashes)], ["id", "key", "component", "hash"])


# A pair of sets shares at least 75/175 of their sizes' sum: the intersection's part of 1.75 times itself.
_SHARED = 100 + LEAST_PERCENT
# Sizes of one class differ by this factor at most.
_SIZE_STEP = 1.1


def _meeting(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): the pairs of different components whose sets share enough of their rarest runs to be similar.

    Of a member's set only the runs that another component here has too can count (reach). With a set of a given size it
    has to share a number of them, so it has to share one of its rarest: as many as are left once one less than that
    number is taken off the most frequent end. A member is posted under these runs, once for each class of sizes that
    its partner may have. What a whole group has in common is so posted by those alone that lack little of it, and
    distant relatives of a large group do not meet its members, however many of either there are. A pair that meets in
    its rarest common run shares no more than either has from there on.
    """
    ids = stored(members.select("id", "component").distinct(), "ids")
    whole = _likely(sets, ids, "id").join(ids, "id").select("id", "key", "component", "set")
    rows = stored(whole.mapInArrow(_shingles, "id long, key long, component long, hash long"), "runs")
    across = rows.groupBy("hash").agg(
        F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("n")
    )
    shared = rows.join(across.where("least < most").select("hash", "n"), "hash")
    of_set = Window.partitionBy("id", "key")
    place = F.row_number().over(of_set.orderBy("n", "hash"))
    ranked = shared.select("*", place.alias("place"), F.count("*").over(of_set).alias("reach"))
    # The prefix of a set of ``size`` runs of which ``needed`` are to be shared.
    prefix = lambda needed: F.col("place") <= F.col("reach") - needed + 1
    rarest = ranked.join(sets.select("id", "key", "size"), ["id", "key"]).where(
        prefix(F.ceil(LEAST_PERCENT * F.col("size") / 100))
    )
    own = F.floor(F.log("size") / F.log(F.lit(_SIZE_STEP))).cast("int")
    rarest = stored(rarest.withColumn("own", own).drop("n"), "runs")
    classes = rarest.groupBy(F.col("own").alias("other")).agg(F.min("size").alias("least"), F.max("size").alias("most"))
    smallest = F.greatest("least", F.ceil(LEAST_PERCENT * F.col("size") / 100))
    near = (100 * F.col("most") >= LEAST_PERCENT * F.col("size")) & (100 * F.col("size") >= LEAST_PERCENT * F.col("least"))
    needed = F.ceil(LEAST_PERCENT * (F.col("size") + smallest) / _SHARED)
    posted = rarest.join(F.broadcast(classes), near & prefix(needed)).select(
        "hash",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        "own",
        "id",
        "component",
        "size",
        (F.col("reach") - F.col("place") + 1).alias("left"),
    )
    posted = stored(_open(stored(posted, "rarest"), "hash", "low", "high"), "rarest")
    left, right = posted.alias("l"), posted.alias("r")
    on = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in ("hash", "low", "high")]
    on += [
        F.col("l.component") < F.col("r.component"),
        (F.col("l.low") == F.col("l.high")) | (F.col("l.own") != F.col("r.own")),
        _SHARED * F.least("l.left", "r.left") >= LEAST_PERCENT * (F.col("l.size") + F.col("r.size")),
    ]
    return _ordered(left.join(right, on), "l.id", "r.id")


def _links(classes: DataFrame, sets_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Confirmed links (a, b) that connect all that is connected."""
    posted = _posted(classes).withColumn("component", F.col("id"))
    lists = ("coordinate", "value")
    members = stored(_open(stored(posted, "postings"), *lists), "members")
    sets = sets_of(stored(members.select("id").distinct(), "ids"))
    # An id may have several sets, told apart by their key.
    size, key = (F.length("set") / 8).cast("long"), F.xxhash64("set")
    sets = stored(sets.select("id", key.alias("key"), size.alias("size"), "set"), "sets")
    tried = links = None
    for turn in itertools.count():
        # Pivots: a member of the first component, one of the last, and one that changes from turn to turn.
        drawn = F.struct(F.xxhash64("id", F.lit(turn)).alias("h"), F.col("component"), F.col("id"))
        own = F.struct(F.lit(0).alias("h"), F.col("component"), F.col("id"))
        pivots = members.groupBy("coordinate", "value").agg(F.array(F.min(own), F.max(own), F.min(drawn)).alias("p"))
        once = F.array_distinct(F.transform("p", lambda p: p.dropFields("h")))
        pivots = pivots.select("coordinate", "value", once.alias("p"))
        starred = members.join(pivots, ["coordinate", "value"]).select("id", "component", F.explode("p").alias("p"))
        met = starred.where("p.component <> component").groupBy("id", F.col("p.id").alias("pivot")).agg(F.count("*").alias("n"))
        met = met.select("id", "n", F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b"))
        if tried is not None:
            met = met.join(tried, ["a", "b"], "left_anti")
        place = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("n"), "a", "b"))
        nearest = met.withColumn("place", place).where(F.col("place") <= PIVOTS_A_TURN)
        new = stored(_ordered(nearest, "a", "b"), "pairs")
        found = stored(_confirmed(stored(_agreeing(new, classes), "pairs"), sets), "links")
        tried = new if tried is None else tried.union(new)
        links = found if links is None else links.union(found)
        n_found = found.count()
        if n_found:
            known = components(links).withColumnRenamed("id", "i").withColumnRenamed("component", "c")
            # One link for each member says what all links so far do: they are not read again.
            links = known.where("c <> i").select(F.col("c").alias("a"), F.col("i").alias("b"))
            labelled = members.join(known, F.col("id") == F.col("i"), "left").select(
                "coordinate", "value", "id", F.coalesce("c", "component").alias("component")
            )
            members = stored(_open(stored(labelled, "members"), *lists), "members")
        if n_found < FEW_LINKS:
            break
    crossed = stored(_meeting(members, sets).join(tried, ["a", "b"], "left_anti"), "pairs")
    return links.union(_confirmed(stored(_agreeing(crossed, classes), "pairs"), sets))


def group(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, class_id) of every row that has an id.

    Documents are linked from a similarity of 0.75 on; a component's id is its smallest doc_id, and that document is
    kept. ``class_id`` is the smallest doc_id with an equal set. A null, empty or blank text has no set, is linked with
    nothing and kept. Repeated rows are given as often as they come; of rows that share an id but not the text each is
    linked by its own, and the id's component is the smallest of theirs. A row without an id has no place in a component:
    it is given with nulls and kept. Other columns are not read, texts are read whole, and an empty table gives none.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_shingles long, key binary, signature array<int>"
    signed = stored(rows.mapInArrow(_sign, schema), "signatures")
    named = signed.where(F.col("doc_id").isNotNull() & F.col("key").isNotNull())
    classes = named.groupBy("key").agg(
        F.min("doc_id").alias("id"), F.any_value("n_shingles").alias("size"), F.any_value("signature").alias("signature")
    )
    classes = stored(classes, "classes")
    # An id may have several texts, and then stand for several classes; each is compared by its own set.
    texts = rows.where(F.col("doc_id").isNotNull())

    def sets_of(ids: DataFrame) -> DataFrame:
        wanted = _likely(texts, ids).join(ids.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi")
        return wanted.mapInArrow(_sets, "id long, set binary").where(F.length("set") > 0).distinct()

    links = _links(classes.select("id", "size", "signature"), sets_of)
    # An id with several texts ties its classes together.
    own = named.join(classes.select("key", F.col("id").alias("class")), "key").select("doc_id", "class")
    ties = own.where("doc_id <> class").select(F.col("class").alias("a"), F.col("doc_id").alias("b"))
    several = ties.join(classes.select(F.col("id").alias("b")), "b", "left_semi")
    found = components(links.union(several.select("a", "b"))).withColumnRenamed("id", "i")
    whole = classes.join(found, F.col("id") == F.col("i"), "left").select(
        "key", F.col("id").alias("class_id"), F.coalesce("component", "id").alias("component_id")
    )
    placed = signed.join(whole, "key", "left")
    component = F.coalesce("component_id", "doc_id")
    return placed.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
    )


def deduplicate(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component: all rows whose id is kept, and of repeated rows one."""
    kept = group(spark, docs).where("kept").select(F.col("doc_id").alias("__id")).distinct()
    rows = docs.dropDuplicates(["doc_id", "text"])
    return rows.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
