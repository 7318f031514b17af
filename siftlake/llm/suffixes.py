"""Problem 2: new batches against all history, by immutable suffix arrays merged logarithmically.

History lies in a folder of its own and outlives the session: a manifest names its tables, and another session opens it again.

* *Suffix arrays.*  A batch's new texts are read as words, one byte of a word's code as its symbol.  The suffixes of the concatenated texts, each cut off
  at the end of its text, are sorted by their first ``DEPTH`` symbols; the sorted arrays, split into buckets by suffix and written bucketed, are a
  *segment*.  Segments are never changed.  When two segments reach the same tier (a power of two of batches) they are merged, bucket by bucket and
  without a shuffle, into one of the next, so there are at most log2(batches) of them, and every suffix is copied log2(batches) times in all.
  Of equal suffixes all holders stay, the earliest first.
* *Texts* by class (equal word sets are one class), bucketed by class; *keys* (hashes of identities, responses and word sets with the earliest instant of
  each), bucketed by key.  Both are only ever added to.

To accept a batch, only the batch is shuffled, to the buckets of history.  Binary search finds, for each suffix of the batch, the range of equal ones in each
segment.  Suffixes start at the words where the running minimum of a window over the hashes of the next ``DEPTH`` words falls (winnowing), so
equal runs of ``DEPTH + WINDOW - 1`` words always share a start, starts in a longer run lie at most ``WINDOW`` apart, and the union of the matches that two
texts have in common spells out their long matches.  That coverage is aggregated per pair of records as a mask of ``BLOCKS`` parts
of the new text.  Pairs covered in at least ``LEAST_BLOCKS`` parts are checked exactly.

Common wording has long ranges, and listing them would pair everything with everything.  Ranges beyond ``HOLDERS`` give their earliest ``FEW`` holders and stay
*open*; what they cover of a new text counts for each of its pairs, so no pair is missed that has a listed suffix.  A text that nothing earlier was found for and
whose open ranges cover enough by themselves is searched for again among all holders, without its most held suffixes as long as those together cover too little to
make a pair.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siftlake.functions.words import mix
from siftlake.session import drop_stage, shared_dir, stage

DEPTH = 8
WINDOW = 6
#: Parts of a text whose coverage is told apart, and how many of them the matches of a candidate must touch.
BLOCKS, LEAST_BLOCKS = 64, 16
#: Suffixes that one bucket should hold.
BUCKET_ROWS = 400_000
#: A range of more than HOLDERS is open: the first search lists its earliest FEW.
HOLDERS, FEW = 16, 2
#: Matches that a search holds at once.
PIECE = 500_000

SEGMENT = "bucket int, keys array<bigint>, cids array<bigint>"
QUERY = "bucket int, q_keys array<bigint>, q_cids array<bigint>, q_masks array<bigint>"
FOUND = "new bigint, other bigint, mask bigint, key bigint, times bigint"
TEXTS = "cid bigint, at bigint, size int, p0 bigint, p1 bigint, p2 bigint, p3 bigint, words array<bigint>"
KEYS = "key bigint, first bigint"


def suffix_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort keys of a text's suffixes, the first ``DEPTH`` symbols of each as signed numbers in the same order, and the parts of the text they cover.

    A text too short for a whole suffix has itself as the only one.
    """
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    symbols = (mix(words, 55) & np.uint64(255)).astype(np.uint64)
    if n < DEPTH:
        symbols = np.concatenate([symbols, np.zeros(DEPTH - n, dtype=np.uint64)])
    count = len(symbols) - DEPTH + 1
    keys = np.zeros(count, dtype=np.uint64)
    for i in range(DEPTH):
        keys |= symbols[i : i + count] << np.uint64(56 - 8 * i)
    rank = mix(keys, 56)
    if count > WINDOW:
        view = np.lib.stride_tricks.sliding_window_view(rank, WINDOW)
        starts = np.unique(view.argmin(axis=1) + np.arange(len(view)))
    else:
        starts = np.array([int(rank.argmin())])
    low = starts * BLOCKS // n
    high = np.minimum((np.minimum(starts + DEPTH, n) * BLOCKS - 1) // n, BLOCKS - 1)
    masks = (np.uint64(2**64 - 1) >> (BLOCKS - 1 - (high - low)).astype(np.uint64)) << low.astype(np.uint64)
    signed = (keys[starts] ^ np.uint64(1 << 63)).view(np.int64)
    order = np.argsort(signed, kind="stable")
    signed, masks = signed[order], masks[order]
    first = np.flatnonzero(np.concatenate([[True], signed[1:] != signed[:-1]]))
    return signed[first], np.bitwise_or.reduceat(masks, first).view(np.int64)


def parities(words: np.ndarray) -> np.ndarray:
    """256 parity bits of a word set, as four numbers; two sets differ in at least as many words as these differ in bits."""
    hashed = mix(words, 58)
    bits = np.zeros(4, dtype=np.uint64)
    np.bitwise_xor.at(bits, (hashed >> np.uint64(6) & np.uint64(3)).astype(int), np.uint64(1) << (hashed & np.uint64(63)))
    return bits.view(np.int64)


def _lists(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    value = batch.column(name)[row]
    return np.asarray(value.values) if value.is_valid else np.empty(0, dtype=np.int64)


def scatter(buckets: int):
    """Texts ``(cid, keys, masks)`` as query rows, one a bucket that their suffixes fall into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(1)
            offsets = column.offsets.to_numpy()
            keys, masks = (c.values.to_numpy()[c.offsets[0].as_py() : c.offsets[len(c)].as_py()] for c in (column, batch.column(2)))
            cids = np.repeat(batch.column(0).to_numpy(), np.diff(offsets))
            place = (mix(keys, 57) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(place, kind="stable")
            cuts = np.searchsorted(place[order], np.arange(buckets + 1))
            rows = [(b, keys[o], cids[o], masks[o]) for b in range(buckets) if len(o := order[cuts[b] : cuts[b + 1]])]
            kinds = (pa.int32(), *(pa.list_(pa.int64()),) * 3)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["bucket", "q_keys", "q_cids", "q_masks"])

    return run


def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(bucket, keys, cids, later_keys, later_cids)`` of two segments as rows of one; of equal suffixes the earlier segment's come first."""
    for batch in batches:
        out: list[list] = [[], []]
        for row in range(batch.num_rows):
            keys = np.concatenate([_lists(batch, c, row) for c in ("keys", "later_keys")])
            cids = np.concatenate([_lists(batch, c, row) for c in ("cids", "later_cids")])
            order = np.argsort(keys, kind="stable")
            out[0].append(keys[order])
            out[1].append(cids[order])
        yield pa.RecordBatch.from_arrays([batch.column("bucket"), *(pa.array(o, pa.list_(pa.int64())) for o in out)], names=["bucket", "keys", "cids"])


def search(whole: bool):
    """Binary search of query rows joined to a segment's rows of their bucket: ``new, other, mask``, matches summed up by pair.

    Unless ``whole``, a range of more than ``HOLDERS`` gives its earliest ``FEW`` and a row without ``other`` but with ``key`` and ``times``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                held, holders = _lists(batch, "keys", row), _lists(batch, "cids", row)
                keys, cids, masks = (_lists(batch, c, row) for c in ("q_keys", "q_cids", "q_masks"))
                first, last = np.searchsorted(held, keys, "left"), np.searchsorted(held, keys, "right")
                times = last - first
                hot = np.flatnonzero(times > HOLDERS) if not whole else np.empty(0, dtype=np.int64)
                if len(hot):
                    yield _matches(cids[hot], None, masks[hot], keys[hot], times[hot].copy())
                    times[hot] = FEW
                ends = np.cumsum(times)
                low = 0
                while low < len(keys):
                    high = max(int(np.searchsorted(ends, (ends[low - 1] if low else 0) + PIECE, "right")), low + 1)
                    n = times[low:high]
                    if n.sum():
                        at = np.repeat(first[low:high], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                        new, other, mask = np.repeat(cids[low:high], n), holders[at], np.repeat(masks[low:high], n)
                        keep = np.flatnonzero(new != other)
                        order = keep[np.lexsort((other[keep], new[keep]))]
                        new, other, mask = new[order], other[order], mask[order]
                        if len(new):
                            edge = np.flatnonzero(np.concatenate([[True], (new[1:] != new[:-1]) | (other[1:] != other[:-1])]))
                            yield _matches(new[edge], other[edge], np.bitwise_or.reduceat(mask, edge), None, None)
                    low = high

    return run


def _matches(*columns: np.ndarray | None) -> pa.RecordBatch:
    length = len(columns[0])
    return pa.RecordBatch.from_arrays([pa.nulls(length, pa.int64()) if c is None else pa.array(c) for c in columns], names=["new", "other", "mask", "key", "times"])


def exact_key(kind: str, *parts: Column) -> Column:
    """The key of a value of some kind; null where the first part is."""
    return F.when(parts[0].isNotNull(), F.xxhash64(F.lit(kind), *parts))


class History:
    """Everything accepted so far, in a folder of the shared file system."""

    def __init__(self, spark: SparkSession, buckets: int, threshold: float, folder: str | None = None) -> None:
        self.spark, self.buckets, self.threshold = spark, buckets, threshold
        self.folder = folder or f"{shared_dir(spark)}/history-{uuid.uuid4().hex}"
        self.batches = 0
        self.segments: list[tuple[int, str]] = []
        self.names: dict[str, str] = {}

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> History:
        """The history that an earlier session left in a folder."""
        last = spark.read.json(f"{folder}/manifest-*").orderBy(F.desc("batches")).first()
        found = cls(spark, last.buckets, last.threshold, folder)
        found.batches, found.segments = last.batches, [(s.tier, s.path) for s in last.segments or ()]
        return found

    def _table(self, path: str, ddl: str, key: str) -> DataFrame:
        """A bucketed table by its place below the folder; it is made known to this session once."""
        if path not in self.names:
            name = f"t{uuid.uuid4().hex}"
            self.spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet CLUSTERED BY ({key}) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{path}'")
            self.names[path] = name
        return self.spark.table(self.names[path])

    def _add(self, rows: DataFrame, path: str, ddl: str, key: str, spread: bool = True) -> None:
        """Add rows to a bucketed table, one file a bucket."""
        self._table(path, ddl, key)
        rows = rows.repartition(self.buckets, key) if spread else rows
        rows.select(*self.spark.table(self.names[path]).columns).write.insertInto(self.names[path])

    def _drop(self, path: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.names.pop(path)}")
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{path}")
        place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)

    def texts(self) -> DataFrame:
        return self._table("texts", TEXTS, "cid")

    def keys(self) -> DataFrame:
        return self._table("keys", KEYS, "key")

    def segment_rows(self) -> list[DataFrame]:
        return [self._table(path, SEGMENT, "bucket") for _, path in self.segments]

    def accept(self, records: DataFrame, exact: tuple[str, ...]) -> DataFrame:
        """Accept a batch: ``id, at`` and, for each name of ``exact`` and for ``content``, the earliest instant of what the record repeats, itself included.

        ``records`` are ``id, at, <exact names>, s1, s2, size, p0 ... p3, words, keys, masks``: ``at`` counts microseconds, the exact columns are keys
        (``exact_key``), the others describe the text and are null without one.  Batches come in the order of their instants.  Rows without ``at`` are
        left out; rows without ``id`` only add their keys.  Earlier batches' records aren't read again, and history isn't shuffled.
        """
        given = records.filter("at is not null").withColumn("content", exact_key("content", F.col("s1"), F.col("s2")))
        marks = (*exact, "content")
        stated = given.select("id", "at", F.posexplode(F.array(*marks)).alias("mark", "key")).filter("key is not null")
        own = stated.groupBy("key").agg(F.min("at").alias("own"))
        met = own.repartition(self.buckets, "key").join(self.keys(), "key", "left").groupBy("key").agg(F.min("own").alias("own"), F.min("first").alias("before"))
        met = stage(met, "met")
        self._add(met.select("key", F.least("own", "before").alias("first")), "keys", KEYS, "key")

        # The new classes, each by its record with the smallest id; a row that was delivered twice may stand twice, which adds nothing below.
        said = given.filter("words is not null and id is not null")
        classes = said.groupBy("content").agg(F.min("at").alias("first"), F.min("id").alias("id"))
        known = met.filter("before is not null").select(F.col("key").alias("content"))
        fresh = said.drop("at").join(classes.join(known, "content", "left_anti").select("id", F.col("first").alias("at")), "id").withColumn("cid", F.col("s1"))
        fresh = stage(fresh.select("content", "cid", "at", "size", "p0", "p1", "p2", "p3", "words", "keys", "masks"), "fresh")
        self._add(fresh, "texts", TEXTS, "cid")
        links = self._search(fresh)

        around = links.join(fresh.select("cid", F.col("content").alias("key")).distinct(), "cid").groupBy("key").agg(F.min("first").alias("around"))
        firsts = met.join(around, "key", "left").select("key", F.least("own", "before", "around").alias("first"))
        hits = stated.filter("id is not null").join(firsts, "key").select("id", "at", "mark", "first")
        every = hits.unionByName(given.filter("id is not null").select("id", "at", F.lit(None).cast("int").alias("mark"), F.lit(None).cast("bigint").alias("first")))
        told = [F.min(F.when(F.col("mark") == k, F.col("first"))).alias(f"first_{m}") for k, m in enumerate(marks)]
        done = stage(every.groupBy("id", "at").agg(*told), "repeats")
        for table in (met, fresh):
            drop_stage(table)
        self.batches += 1
        self._note()
        return done

    def _search(self, fresh: DataFrame) -> DataFrame:
        """Links ``(cid, first)`` of a batch's new texts: the instants of those in history or batch within the threshold."""
        queries = stage(fresh.select("cid", "keys", "masks").mapInArrow(scatter(self.buckets), QUERY).repartition(self.buckets, "bucket"), "queries")
        own = f"segment-{self.batches}-0"
        ordered = fresh.sortWithinPartitions("at").select("cid", "keys", "masks")
        rows = ordered.mapInArrow(scatter(self.buckets), QUERY).groupBy("bucket").agg(F.flatten(F.collect_list("q_keys")).alias("keys"), F.flatten(F.collect_list("q_cids")).alias("cids"))
        none = F.lit(None).cast("array<bigint>")
        sorted_ = rows.repartition(self.buckets, "bucket").withColumns({"later_keys": none, "later_cids": none}).mapInArrow(merge, SEGMENT)
        self._add(sorted_, own, SEGMENT, "bucket", spread=False)
        self.segments.append((0, own))
        matches = stage(self._matched(queries), "matches")
        links = stage(self._checked(matches.filter("other is not null").select("new", "other"), fresh), "links")
        earlier = links.join(fresh.select("cid", "at"), "cid").filter("first < at").select(F.col("cid").alias("new")).distinct()
        again = stage(self._unlisted(matches.filter("other is null").join(earlier, "new", "left_anti")).mapInArrow(scatter(self.buckets), QUERY), "queries")
        more = self._found(again, True).filter("other is not null").select("new", "other").distinct()
        rest = stage(self._checked(more, fresh), "links")
        for table in (queries, again, matches):
            drop_stage(table)
        self._merge_tiers()
        return links.unionByName(rest)

    def _found(self, queries: DataFrame, whole: bool) -> DataFrame:
        """What the binary search finds in all live segments; the queries alone are shuffled."""
        at_home = queries.repartition(self.buckets, "bucket")
        met = None
        for segment in self.segment_rows():
            part = at_home.join(segment, "bucket").mapInArrow(search(whole), FOUND)
            met = part if met is None else met.unionByName(part)
        return met

    def _matched(self, queries: DataFrame) -> DataFrame:
        """Candidate pairs ``new, other`` and, without ``other``, the open suffixes (``key, times, mask``) of texts whose open ranges cover enough by themselves."""
        rows = self._found(queries, False).repartition("new").groupBy("new", "other", "key").agg(F.bit_or("mask").alias("mask"), F.sum("times").alias("times"))
        open_ = F.coalesce(F.bit_or(F.when(F.col("other").isNull(), F.col("mask"))).over(W.partitionBy("new")), F.lit(0).cast("bigint"))
        covered = rows.withColumn("open", open_).filter(F.bit_count(F.col("mask").bitwiseOR(F.col("open"))) >= LEAST_BLOCKS)
        return covered.select("new", "other", "key", "times", "mask")

    def _unlisted(self, open_: DataFrame) -> DataFrame:
        """Texts ``cid, keys, masks`` with the open suffixes to search for among all holders.

        A pair covered enough isn't covered by the most held suffixes alone as long as these together cover too little.
        """
        so_far = W.partitionBy("new").orderBy(F.desc("times"), "key").rowsBetween(W.unboundedPreceding, 0)
        asked = open_.withColumn("covered", F.bit_or("mask").over(so_far)).filter(F.bit_count("covered") >= LEAST_BLOCKS)
        return asked.groupBy(F.col("new").alias("cid")).agg(F.collect_list("key").alias("keys"), F.collect_list("mask").alias("masks"))

    def _checked(self, pairs: DataFrame, fresh: DataFrame) -> DataFrame:
        """Links ``(cid, first)`` of candidate pairs within the threshold, exactly; parity bits rule out most pairs before their words are fetched."""
        bits = ("size", "p0", "p1", "p2", "p3")
        mine = fresh.select(F.col("cid").alias("new"), *(F.col(c).alias(f"n_{c}") for c in bits))
        asked = pairs.select("new", "other").join(mine, "new").repartition(self.buckets, "other")
        held = self.texts().select(F.col("cid").alias("other"), F.col("at").alias("first"), *bits)
        apart = sum(F.bit_count(F.col(f"n_{c}").bitwiseXOR(F.col(c))) for c in bits[1:])
        bound = (F.col("n_size") + F.col("size")) * ((1 - self.threshold) / (1 + self.threshold)) + 1e-6
        near = stage(asked.join(held, "other").filter(apart <= bound).select("new", "other", "first"), "near")
        theirs = self.texts().select(F.col("cid").alias("other"), F.col("words").alias("y"))
        both = near.join(fresh.select(F.col("cid").alias("new"), F.col("words").alias("x")), "new").repartition(self.buckets, "other").join(theirs, "other")
        common = F.size(F.array_intersect("x", "y"))
        union = F.size("x") + F.size("y") - common
        return both.filter((common / union >= self.threshold - 1e-12) | (union == 0)).select(F.col("new").alias("cid"), "first")

    def _merge_tiers(self) -> None:
        """Merge the last two segments as long as they are of one tier; both lie in the same buckets, so nothing is shuffled."""
        while len(self.segments) > 1 and self.segments[-1][0] == self.segments[-2][0]:
            (tier, later), (_, earlier) = self.segments.pop(), self.segments.pop()
            a, b = self._table(earlier, SEGMENT, "bucket"), self._table(later, SEGMENT, "bucket")
            both = a.join(b.select("bucket", F.col("keys").alias("later_keys"), F.col("cids").alias("later_cids")), "bucket", "full")
            path = f"segment-{self.batches}-{tier + 1}"
            self._add(both.mapInArrow(merge, SEGMENT), path, SEGMENT, "bucket", spread=False)
            self.segments.append((tier + 1, path))
            self._drop(earlier)
            self._drop(later)

    def _note(self) -> None:
        """Write the manifest of the state after a batch; the one with the most batches holds."""
        rows = [(self.batches, self.buckets, self.threshold, [(t, p) for t, p in self.segments])]
        note = self.spark.createDataFrame(rows, "batches int, buckets int, threshold double, segments array<struct<tier int, path string>>")
        note.coalesce(1).write.mode("overwrite").json(f"{self.folder}/manifest-{self.batches}")

    def forget(self) -> None:
        """Delete the history with all its files."""
        for path in list(self.names):
            self._drop(path)
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
