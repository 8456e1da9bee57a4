"""N-gram Jaccard join by MinHash banding.

Texts are sets of five-word shingles. Texts with equal sets form one class and
travel as one row from then on. Every class gets a MinHash signature, cut into
bands; the numbers of bands and rows are the smallest that find a pair at the
threshold with the wanted recall. Classes that share a band meet, and each pair
that meets is verified on the full sets.

Large meetings: a bucket of m classes is cut into blocks, and each pair of blocks
is one task, so no task grows with the bucket and no pair is emitted. A task
hands on, per class, its number of verified links and the smallest class it is
connected with, which is enough for exact link counts and connected groups. A
pair that meets in several bands counts in the first of them only; buckets with
the same members as an earlier one are left out before any set is moved.

Defined results: words are separated by white space, A-Z are lower-cased; a text
of one to four words is one shingle; null and empty texts have no shingles and
link to nothing, each row being its own class. Rows with null ids take part like
others. ``class_id`` is the smallest id of the group, null only where all its ids
are null. Repeated rows are copies of each other and count as such.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractcheck.functions.lineage import settled
from contractcheck.llm.words import LOWER, NOT_BLANK, hash_spans, map_columns, mix, shingle_hashes, slices

SHINGLE, THRESHOLD, RECALL = 5, 0.8, 0.999
#: Classes of one block; a task verifies the pairs of at most two blocks.
BLOCK = 512
#: Up to so many classes a task compares set by set, beyond that by matrix products.
FEW = 12


def band_plan(threshold: float = THRESHOLD, recall: float = RECALL, chance: float = 0.1, most: int = 512) -> tuple[int, int]:
    """(bands, rows): the fewest hashes that find a pair at the threshold with the wanted recall.

    Pairs below half the threshold may meet with a mean probability of ``chance``.
    """
    below = np.linspace(0, threshold / 2, 50)
    plans = []
    for rows in range(1, 17):
        bands = next((b for b in range(1, most // rows + 1) if 1 - (1 - threshold**rows) ** b >= recall), None)
        if bands and np.mean(1 - (1 - below**rows) ** bands) <= chance:
            plans.append((bands * rows, bands, rows))
    if not plans:
        raise ValueError(f"no plan within {most} hashes reaches a recall of {recall} at {threshold}")
    return min(plans)[1:]


def _sets(texts: pa.Array, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per slice: shingle hashes of all texts and their offsets."""
    for s in slices(texts):
        low = LOWER[s.buf]
        starts, ends = s.spans(NOT_BLANK, low)
        yield shingle_hashes(hash_spans(low, starts, ends), s.per_text(starts), size)


def _key(hashes: np.ndarray) -> tuple[bytes, np.ndarray]:
    distinct = np.unique(hashes)
    return hashlib.blake2b(distinct.tobytes(), digest_size=16).digest(), distinct


def signatures(df: DataFrame, id_col: str, text_col: str, size: int, bands: int, rows: int) -> DataFrame:
    """Per input row: id, ``row_hash`` of id and text, ``set_key``, ``bands``.

    ``set_key`` is equal for equal shingle sets, and null for texts without shingles.
    """
    factors = mix(np.arange(1, bands * rows + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
    weights = mix(np.arange(1, rows + 1, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB)) | np.uint64(1)

    def make(ids, row_hashes, texts):
        keys, all_bands = [], []
        for hashes, at in _sets(texts, size):
            full = np.flatnonzero(np.diff(at))
            out = np.zeros((len(full), bands), dtype=np.uint64)
            for b in range(bands):
                for r in range(rows):
                    least = np.minimum.reduceat(hashes * factors[b * rows + r], at[full]) if len(full) else hashes
                    out[:, b] += least * weights[r]
                out[:, b] = mix(out[:, b] + np.uint64(b))
            own: list = [None] * (len(at) - 1)
            for k, i in enumerate(full.tolist()):
                own[i] = out[k].view(np.int64)
            all_bands += own
            keys += [_key(hashes[a:b])[0] if a < b else None for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        return {id_col: ids, "row_hash": row_hashes, "set_key": pa.array(keys, pa.binary()), "bands": pa.array(all_bands, pa.list_(pa.int64()))}

    kind = df.schema[id_col].dataType.simpleString()
    named = df.select(F.col(id_col), row_hash(id_col, text_col).alias("row_hash"), F.col(text_col))
    return map_columns(named, named.columns, make, f"`{id_col}` {kind}, row_hash binary, set_key binary, bands array<bigint>")


def row_hash(id_col: str, text_col: str):
    """128 bits that stand for id and text: null and empty differ, and neither runs into the other."""
    given = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    marks = F.concat(F.when(F.col(id_col).isNull(), "n").otherwise("i"), F.char_length(given).cast("string"), F.when(F.col(text_col).isNull(), "n").otherwise("t"))
    return F.unhex(F.md5(F.concat(marks, given, F.coalesce(F.col(text_col), F.lit(""))).cast("binary")))


def joined_by_weight(rows: DataFrame, per_key: DataFrame, key: str, weight: str) -> DataFrame:
    """``rows`` with the columns of ``per_key``, which has one row per key and, as ``weight``, how many of ``rows`` it meets.

    Keys that hold more than a task's share of the rows, fewer than there are tasks, are
    broadcast, so that their rows stay where they are; the others are shuffled.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = per_key.agg(F.sum(weight)).first()[0] or 0
    heavy = F.col(weight) * tasks > total
    hot = F.broadcast(per_key.where(heavy).drop(weight))
    rest = rows.join(F.broadcast(per_key.where(heavy).select(key)), key, "left_anti")
    return rows.join(hot, key).unionByName(rest.join(per_key.where(~heavy).drop(weight), key))


def full_sets(df: DataFrame, text_col: str, size: int) -> DataFrame:
    """``set_key`` and ``shingles`` of every row that has any."""

    def make(texts):
        keys, found = [], []
        for hashes, at in _sets(texts, size):
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                if a < b:
                    key, distinct = _key(hashes[a:b])
                    keys.append(key)
                    found.append(distinct.view(np.int64))
        return {"set_key": pa.array(keys, pa.binary()), "shingles": pa.array(found, pa.list_(pa.int64()))}

    return map_columns(df, [text_col], make, "set_key binary, shingles array<bigint>")


def _shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left with every right set."""
    if len(left) + len(right) <= 2 * FEW:
        return np.array([[len(np.intersect1d(a, b, assume_unique=True)) for b in right] for a in left]).reshape(len(left), len(right))
    every = left + right
    sizes = np.array([len(x) for x in every])
    values, column, counts = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(every)), sizes)
    rank = np.cumsum(counts > 1) - 1
    often = counts[column] > 1
    owner, column = owner[often], rank[column[often]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(left), len(right)), dtype=np.float32)
    width = 2048
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (lo, lo + width))
        part = np.zeros((len(every), width), dtype=np.float32)
        part[owner[a:b], column[a:b] - lo] = 1
        total += part[: len(left)] @ part[len(left) :].T
    return total.astype(np.int64)


def verify(band: int, left: list[tuple], right: list[tuple] | None, threshold: float) -> Iterator[tuple[bytes, int, bytes]]:
    """Links among ``left``, or between ``left`` and ``right``: (class, linked documents, smallest connected class).

    A member is (key, copies, bands, set). Only pairs that share no band before ``band`` count.
    """
    other = left if right is None else right
    a_bands, b_bands = np.stack([m[2] for m in left]), np.stack([m[2] for m in other])
    fresh = np.ones((len(left), len(other)), dtype=bool)
    for p in range(band):
        fresh &= a_bands[:, p, None] != b_bands[None, :, p]
    # Salted blocks also hold members of other buckets only by collision of the task key: both must have this band.
    fresh &= a_bands[:, band, None] == b_bands[None, :, band]
    if right is None:
        fresh &= ~np.eye(len(left), dtype=bool)
    if not fresh.any():
        return
    both = _shared_counts([m[3] for m in left], [m[3] for m in other])
    sizes = np.array([len(m[3]) for m in left])[:, None] + np.array([len(m[3]) for m in other])[None, :] - both
    linked = fresh & (both >= threshold * sizes - 1e-9)
    if not linked.any():
        return
    copies_a, copies_b = np.array([m[1] for m in left]), np.array([m[1] for m in other])
    members = left if right is None else left + right
    n, k = len(members), len(left)
    if right is None:
        near, links = linked, linked @ copies_b
    else:
        near = np.zeros((n, n), dtype=bool)
        near[:k, k:], near[k:, :k] = linked, linked.T
        links = np.concatenate((linked @ copies_b, linked.T @ copies_a))
    rank = np.argsort(np.argsort([m[0] for m in members]))
    label = rank.copy()
    while True:
        spread = np.minimum(label, np.where(near, label[None, :], n).min(axis=1))
        if (spread == label).all():
            break
        label = spread
    by_rank = {int(r): m[0] for r, m in zip(rank, members, strict=True)}
    for i in np.flatnonzero(near.any(axis=1)):
        yield members[i][0], int(links[i]), by_rank[int(label[i])]


def _verified(tasks: DataFrame, threshold: float) -> DataFrame:
    """Runs of rows with equal (bucket, pair of blocks) are one task each."""

    def rows(batches):
        for batch in batches:
            columns = [batch.column(i) for i in range(batch.num_columns)]
            names, lists = batch.schema.names, {}
            for name in ("bands", "shingles"):
                c = columns[names.index(name)]
                lists[name] = (c.values.to_numpy(zero_copy_only=False), c.offsets.to_numpy())
            plain = {n: columns[names.index(n)].to_pylist() for n in names if n not in lists}
            for i in range(batch.num_rows):
                yield {n: v[i] for n, v in plain.items()} | {n: v[o[i] : o[i + 1]].copy() for n, (v, o) in lists.items()}

    def run(batches):
        task, left, right = None, [], []
        out: list[tuple] = []

        def close():
            if left and (right or (task[2] == task[3] and len(left) > 1)):
                out.extend(verify(task[0], left, right or None, threshold))

        def done():
            keys, links, hubs = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(links, pa.int64()), pa.array(hubs, pa.binary())], names=["set_key", "links", "hub"])

        for row in rows(batches):
            now = (row["band"], row["bucket"], row["i"], row["j"])
            if now != task:
                close()
                task, left, right = now, [], []
                if len(out) >= 5000:
                    yield done()
                    out.clear()
            (left if row["block"] == row["i"] else right).append((row["set_key"], row["copies"], row["bands"], row["shingles"]))
        close()
        if out:
            yield done()

    sorted_tasks = tasks.repartition("band", "bucket", "i", "j").sortWithinPartitions("band", "bucket", "i", "j")
    return sorted_tasks.mapInArrow(run, "set_key binary, links bigint, hub binary")


def components(edges: DataFrame) -> DataFrame:
    """Connected groups of undirected edges ``a``, ``b``: one row ``node``, ``label`` per node.

    Smallest labels spread to neighbours, then along themselves, so long chains
    shrink by half or more in each round. Rounds hand over checkpointed rows.
    """
    n = 2 * edges.count()
    both = settled(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), n)
    labels = settled(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), n)
    while True:
        heard = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("m"))
        nearer = labels.join(heard, "node", "left").select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        roots = nearer.select(F.col("node").alias("label"), F.col("label").alias("up"))
        then = settled(nearer.join(roots, "label", "left").select("node", "old", F.least("label", "up").alias("label")), n)
        labels = then.select("node", "label")
        if then.where(F.col("old") != F.col("label")).isEmpty():
            return labels


def join_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, recall: float = RECALL, size: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """Per input row: id, ``row_hash``, ``class_id``, ``n_links`` and ``group_key``.

    ``n_links`` counts the other documents with a Jaccard similarity of at least
    ``threshold``; ``class_id`` is shared by all that are connected through links.
    ``group_key`` is the same for the rows of a group, null for texts without shingles.
    """
    return _counted_rows(df, id_col, text_col, threshold, recall, size, block)[0]


def _counted_rows(df: DataFrame, id_col: str, text_col: str, threshold: float = THRESHOLD, recall: float = RECALL, size: int = SHINGLE, block: int = BLOCK) -> tuple[DataFrame, int]:
    """The rows of :func:`join_rows` and their number, which bounds the files of what is settled on the way."""
    bands, rows = band_plan(threshold, recall)
    signed = settled(signatures(df, id_col, text_col, size, bands, rows))
    n = signed.count()
    classes = settled(
        signed.where("set_key IS NOT NULL")
        .groupBy("set_key")
        .agg(F.count("*").alias("copies"), F.min(F.col(id_col)).alias("first_id"), F.min("row_hash").alias("first_row"), F.first("bands").alias("bands")),
        n,
    )
    met = classes.select("set_key", F.posexplode("bands").alias("band", "bucket"))
    buckets = (
        met.groupBy("band", "bucket")
        .agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64("set_key")).alias("x"), F.sum(F.hash("set_key").cast("bigint")).alias("y"))
        .where("m > 1")
        .groupBy("m", "x", "y")
        .agg(F.min(F.struct("band", "bucket")).alias("first"))
        .select("first.band", "first.bucket", F.ceil(F.col("m") / block).cast("int").alias("blocks"))
    )
    members = settled(met.join(buckets, ["band", "bucket"]), n * bands)
    found = classes.join(members.select("set_key").distinct(), "set_key", "left_semi")
    texts = df.select(F.col(text_col).alias("text"), row_hash(id_col, text_col).alias("first_row")).join(found.select("first_row"), "first_row", "left_semi")
    sets = full_sets(texts, "text", size).groupBy("set_key").agg(F.first("shingles").alias("shingles"))
    own = F.pmod(F.xxhash64("set_key", F.lit(7)), F.col("blocks")).cast("int")
    tasks = (
        members.withColumn("block", own)
        .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("set_key", "band", "bucket", "block", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"))
        .join(classes.select("set_key", "copies", "bands"), "set_key")
        .join(sets, "set_key")
    )
    links = settled(_verified(tasks, threshold))
    counted = links.groupBy("set_key").agg(F.sum("links").alias("links"))
    edges = links.where("set_key <> hub").select(F.col("set_key").alias("a"), F.col("hub").alias("b"))
    groups = components(edges).select(F.col("node").alias("set_key"), F.col("label").alias("group_key"))
    linked = classes.join(counted, "set_key", "left").join(groups, "set_key", "left")
    known = settled(
        linked.select("set_key", "copies", "first_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("group_key", "set_key").alias("group_key")),
        n,
    )
    smallest = settled(known.groupBy("group_key").agg(F.min("first_id").alias("class_id"), F.count("*").alias("classes")), n)
    told = settled(joined_by_weight(known.drop("first_id"), smallest, "group_key", "classes"), n)
    rows_of = signed.select(F.col(id_col), "row_hash", "set_key")
    linked_rows = joined_by_weight(rows_of.where("set_key IS NOT NULL"), told, "set_key", "copies")
    alone = rows_of.where("set_key IS NULL").select(
        F.col(id_col), "row_hash", F.col(id_col).alias("class_id"), F.lit(0).cast("bigint").alias("n_links"), F.lit(None).cast("binary").alias("group_key")
    )
    return linked_rows.select(F.col(id_col), "row_hash", "class_id", F.col("n_links").cast("bigint").alias("n_links"), "group_key").union(alone), n


def jaccard_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per input row: id, ``class_id`` and ``n_links``; see :func:`join_rows`."""
    return join_rows(df, id_col, text_col, **options).select(id_col, "class_id", "n_links")


def one_per_group(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` without all but one of each group of near copies.

    The row with the smallest id stays (null ids last, then by a hash of id and
    text). Rows without any shingle all stay. Of rows equal in id and text one stays.
    """
    told = settled(*_counted_rows(df, id_col, text_col, **options))
    rank = F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("i"), F.col("row_hash").alias("h"))
    winners = told.where("group_key IS NOT NULL").groupBy("group_key").agg(F.min(rank).alias("w"), F.count("*").alias("size")).select("group_key", F.col("w.h").alias("__llm_row"))
    times = told.where("group_key IS NOT NULL").groupBy(F.col("row_hash").alias("__llm_row")).agg(F.count("*").alias("__llm_times"))
    kept = winners.join(times, "__llm_row").select("__llm_row", "__llm_times")
    empty = told.where("group_key IS NULL").select(F.col("row_hash").alias("__llm_row")).distinct().withColumn("__llm_times", F.lit(1).cast("bigint"))
    rows = df.withColumn("__llm_row", row_hash(id_col, text_col)).join(kept.union(empty), "__llm_row")
    once = rows.where("__llm_times = 1")
    repeated = rows.where("__llm_times > 1").dropDuplicates(["__llm_row"])
    return once.union(repeated).select(df.columns)
