"""Near-duplicate documents: SuperMinHash, banding, verification and union-find grouping.

1. One pass over the texts makes each document's set of word shingles, its size, a digest of the set and the
   SuperMinHash signature, folded to one number for each band.  Documents with equal sets are grouped by the digest.
2. Among distinct sets, those that share a band meet in a bucket.  A bucket never emits its pairs: it compares the
   members' signatures where it stands and emits the tree of most similar pairs that joins what may be linked; these
   pairs are confirmed on the full sets.  Buckets of more than BLOCK members are dealt out as pairs of blocks.
3. Of buckets with more such pairs, members that have one in another group come once more with their full sets, dealt in
   blocks of up to ITEMS shingles; every pair left is confirmed where it stands, and only links that join groups
   leave, fewer than members.
4. Confirmed links are folded into groups by minimum labels with pointer jumping, all in tables of the shared folder.

A pair with similarity s shares a band with chance 1 - (1 - s**5)**25: 0.9999996 at 0.85.  Pairs go on to the full sets if
their signatures agree in all but SLACK less than the wanted share of SIZE places, 5.5 standard deviations at 0.85: by the
binomial 1.4 pairs in ten million are lost there, fewer than by the bands (4.3).

A set is known by its digest, not by a doc_id; a component is named by the smallest doc_id of its rows, and the set that
has it (of several, the one with the smallest digest) is kept.

Cases: null text and texts without words have the empty set and are linked with nothing; a text of fewer words than a
shingle is one shingle; rows of one doc_id with equal sets are one document, with different sets they are documents of
their own; a null doc_id comes after all others, so that its rows are grouped by their sets like any, and a component of
such rows only has a null name; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .op5_quality import content_key
from .text import BROADCAST_ROWS, lowered, matching, mixed, range_sums, slices, table, utf8, words

WIDTH = 5
BANDS, ROWS = 25, 5
SIZE = 200     # components of a signature; the first BANDS * ROWS make the bands
SLACK = 0.14   # how far below the wanted similarity signatures may agree
PERCENT = 85
BLOCK = 4096   # members of a bucket that one task compares with as many others
ITEMS = 1 << 20  # shingles of a bucket that one task holds twice over, about
SLICE = 1 << 20  # bytes of text whose shingles are made at a time


def shingle_sets(column, width: int):
    """Sorted distinct shingle hashes of each row of a string column."""
    import numpy as np

    data, offsets = utf8(column)
    for a, b in slices(offsets, SLICE):
        part = lowered(data[offsets[a] : offsets[b]])
        start, end, rows = words(part, offsets[a : b + 1] - offsets[a])
        names = range_sums(part, start, end)
        count = np.diff(rows)
        many = np.where(count >= width, count - width + 1, np.minimum(count, 1))
        at = np.cumsum(many) - many
        first = np.repeat(rows[:-1] - at, many) + np.arange(int(many.sum()))
        hashes = range_sums(names, first, first + np.repeat(np.minimum(count, width), many))
        for k, n in zip(at.tolist(), many.tolist()):
            yield np.unique(hashes[k : k + n])


def _pieces(batches):
    """The batches in pieces of about SLICE bytes of text, so that a task holds and hands on the sets of few texts at a time."""
    for batch in batches:
        for a, b in slices(utf8(batch.column("text"))[1], SLICE):
            yield batch.slice(a, b - a)


def _released(run):
    """The task function ``run``, after which its worker, kept for other tasks, hands unused memory back."""
    def task(batches):
        import pyarrow as pa

        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return task


def superminhash(elements, m: int):
    """The SuperMinHash signature of distinct 64-bit elements as whole part and fraction in one number.

    Step j deals every element its j-th place of a random permutation of the m components (a partial Fisher-Yates
    shuffle) with the value j + fraction; once all components hold a value below j + 1, later steps can't change
    them, so a set of many elements stops after one or two steps."""
    import numpy as np

    golden, low = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFFFFFFFF)
    best = np.full(m, np.iinfo(np.uint64).max, np.uint64)
    rows = perm = first = None
    for j in range(m):
        z = mixed(elements + np.uint64(j + 1) * golden)
        k = j + (((z >> np.uint64(32)) * np.uint64(m - j)) >> np.uint64(32)).astype(np.int64)
        if j == 0:
            first = place = k
        else:
            if perm is None:
                rows = np.arange(len(elements))
                perm = np.tile(np.arange(m, dtype=np.int16), (len(elements), 1))
                perm[rows, first] = 0
                perm[:, 0] = first
            place = perm[rows, k]
            perm[rows, k] = perm[:, j]
            perm[:, j] = place
        np.minimum.at(best, place, (np.uint64(j) << np.uint64(32)) | (z & low))
        if int(best.max()) >> 32 <= j:
            break
    return best


def _sketch(width: int, bands: int, rows: int, size: int):
    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        weights = mixed(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
        salt = mixed(np.arange(1, bands + 1, dtype=np.uint64) << np.uint64(20))
        for batch in _pieces(batches):
            sizes, keys, folded, signs = [], [], [], []
            for s in shingle_sets(batch.column("text"), width):
                sizes.append(len(s))
                if not len(s):
                    for x in (keys, folded, signs):
                        x.append(None)
                    continue
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                signature = superminhash(s, size)
                folded.append(mixed((signature[: bands * rows].reshape(bands, rows) * weights).sum(1) + salt).view(np.int64))
                signs.append(mixed(signature).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("content"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(folded, pa.list_(pa.int64())), pa.array(signs, pa.binary())],
                names=["doc_id", "content", "n", "key", "bands", "sign"])

    return _released(run)


def _sets(width: int):
    def run(batches):
        import pyarrow as pa

        for batch in _pieces(batches):
            raw = [s.tobytes() for s in shingle_sets(batch.column("text"), width)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(raw, pa.binary())], names=["node", "items"])

    return _released(run)


def _confirm(percent: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    return _released(run)


def components(edges: DataFrame) -> DataFrame:
    """node, label (the smallest node reachable) for the nodes of an edge table (a, b).

    Each round a node takes the smallest label of itself and its neighbours and then the label of that label; the
    labels are a table written anew each round, and one number tells whether any changed."""
    both = cut_lineage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        new = labels.join(near, labels["node"] == near["a"]).select("node", "label", F.least("label", "near").alias("to"))
        jump = labels.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
        new = cut_lineage(new.join(jump, F.col("to") == F.col("_n")).select(
            "node", F.col("label").alias("old"), F.least("to", "_l").alias("label")))
        if new.where("label < old").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")


def buckets(sets: DataFrame) -> DataFrame:
    """band, hash, lo, hi, block, rep for the members of buckets of several distinct sets; a bucket of more than
    BLOCK members is dealt out as all pairs (lo, hi) of its blocks."""
    rows = sets.select("rep", F.posexplode("bands").alias("band", "hash"))
    return _dealt(rows, F.count(F.lit(1)) / BLOCK).select("band", "hash", "lo", "hi", "block", "rep")


def _dealt(rows: DataFrame, blocks) -> DataFrame:
    """Members (band, hash, rep) of buckets of several, each bucket dealt out as all pairs (lo, hi) of its blocks."""
    many = rows.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("members"), F.ceil(blocks).cast("int").alias("blocks")).where("members > 1")
    many = many.select(F.col("band").alias("_b"), F.col("hash").alias("_h"), "blocks")
    met = rows.join(many, (F.col("band") == F.col("_b")) & (F.col("hash") == F.col("_h"))).drop("_b", "_h")
    met = met.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")).drop("blocks", "other")


def likely(signs, sizes, labels, sides, bands, band: int, least: float, percent: int):
    """(share, i, j) arrays of pairs of different labels that may be linked.  A pair that shares several bands is looked at in
    the first of them only."""
    import numpy as np

    found, step = [], max(1, (1 << 24) // (len(signs) * signs.shape[1] + 1))
    for a in range(0, len(signs), step):
        same = (signs[a : a + step, None, :] == signs[None, a:, :]).sum(2, dtype=np.int32)
        i, j = np.nonzero(same >= least * signs.shape[1])
        share, i, j = same[i, j], i + a, j + a
        good = (i < j) & (labels[i] != labels[j]) & (100 * np.minimum(sizes[i], sizes[j]) >= percent * np.maximum(sizes[i], sizes[j]))
        if sides is not None:
            good &= sides[i] != sides[j]
        share, i, j = share[good], i[good], j[good]
        once = ~(bands[i, :band] == bands[j, :band]).any(1)
        found.append((share[once], i[once], j[once]))
    return [np.concatenate(x) for x in zip(*found)]


def tree(share, i, j, labels):
    """Places of the most similar pairs that join the labels."""
    import numpy as np

    up = {}

    def find(x):
        while x in up:
            x = up[x]
        return x

    keep = []
    for k in np.argsort(-share, kind="stable").tolist():
        x, y = find(int(labels[i[k]])), find(int(labels[j[k]]))
        if x != y:
            up[x] = y
            keep.append(k)
    return keep


def linking(items, sizes, labels, i, j, percent: int):
    """Places of pairs that are linked by their full sets and join two labels that the ones before do not join.

    One member is compared with all others at a time: its items are marked among those of all members."""
    import numpy as np

    codes = np.unique(np.concatenate(items), return_inverse=True)[1].astype(np.int32)
    start = np.concatenate([[0], np.cumsum([len(x) for x in items])])
    marked, labels, keep = np.zeros(int(codes.max()) + 1, bool), labels.copy(), []
    order = np.argsort(i, kind="stable")
    cut = np.searchsorted(i[order], np.arange(len(items) + 1))
    for a in range(len(items)):
        pairs = order[cut[a] : cut[a + 1]]
        pairs = pairs[labels[j[pairs]] != labels[a]]
        if not len(pairs):
            continue
        own = codes[start[a] : start[a + 1]]
        marked[own] = True
        for p in np.array_split(pairs, -(-len(pairs) // 256)):
            b = j[p]
            counts = start[b + 1] - start[b]
            ends = np.cumsum(counts)
            at = np.repeat(start[b] - (ends - counts), counts) + np.arange(int(ends[-1]))
            both = np.add.reduceat(marked[codes[at]].astype(np.int64), ends - counts)
            for k in p[100 * both >= percent * (sizes[a] + sizes[b] - both)].tolist():
                if labels[j[k]] != labels[a]:
                    keep.append(k)
                    labels[labels == labels[j[k]]] = labels[a]
        marked[own] = False
    return keep


def _by_bucket(columns: list[str], out: str, settle):
    """Task function over rows sorted by bucket: ``settle`` (key, its rows) gives the rows of the columns ``out``."""
    def run(batches):
        import pyarrow as pa

        names = [c.split()[0] for c in out.split(", ")]
        types = [pa.int32() if c.split()[1] == "int" else pa.int64() for c in out.split(", ")]

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)

        now, rows = None, []
        for batch in batches:
            done = []
            for *key, row in zip(*[batch.column(c).to_pylist() for c in ("band", "hash", "lo", "hi")],
                                 zip(*[batch.column(c).to_pylist() for c in columns])):
                if key != now and rows:
                    done += settle(now, rows)
                    rows = []
                now = key
                rows.append(row)
            yield table(done)
        if rows:
            yield table(settle(now, rows))

    return _released(run)


SHOWN = ["sign", "rep", "n", "label", "block", "bands"]


def _seen(band: int, rows, percent: int):
    """reps, sizes and labels of the rows (SHOWN) of a bucket, and its pairs that may be linked."""
    import numpy as np

    signs = np.frombuffer(b"".join(r[0] for r in rows), np.uint8).reshape(len(rows), -1)
    reps, sizes, labels, block, bands = (np.array([r[k] for r in rows], np.int64) for k in range(1, 6))
    sides = block if block.min() != block.max() else None
    return reps, sizes, labels, likely(signs, sizes, labels, sides, bands, band, percent / 100 - SLACK, percent)


def _candidates(percent: int):
    """The tree of pairs (a, b) of each bucket to be confirmed, and a row without pair for a bucket that has more."""
    def settle(key, rows):
        reps, _, labels, (share, i, j) = _seen(key[0], rows, percent)
        keep = tree(share, i, j, labels)
        more = [(None, None, *key[:2])] if len(keep) < len(i) else []
        return [(min(a, b), max(a, b), None, None) for a, b in zip(reps[i[keep]].tolist(), reps[j[keep]].tolist())] + more

    return _by_bucket(SHOWN, "a long, b long, band int, hash long", settle)


def _open(percent: int):
    """Members of each bucket that have a pair to be confirmed there."""
    def settle(key, rows):
        import numpy as np

        reps, sizes, _, (_, i, j) = _seen(key[0], rows, percent)
        at = np.unique(np.concatenate([i, j]))
        return [(*key[:2], rep, n) for rep, n in zip(reps[at].tolist(), sizes[at].tolist())]

    return _by_bucket(SHOWN, "band int, hash long, rep long, n long", settle)


def _links(percent: int):
    """Links (a, b) of each bucket by the full sets, as many as join what is linked there."""
    def settle(key, rows):
        import numpy as np

        reps, sizes, labels, (_, i, j) = _seen(key[0], rows, percent)
        if not len(i):
            return []
        keep = linking([np.frombuffer(r[6], np.uint64) for r in rows], sizes, labels, i, j, percent)
        return [(min(a, b), max(a, b)) for a, b in zip(reps[i[keep]].tolist(), reps[j[keep]].tolist())]

    return _by_bucket([*SHOWN, "items"], "a long, b long", settle)


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """node, label after the labels of linked nodes are joined."""
    if links.isEmpty():
        return labels
    own = labels.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
    other = labels.select(F.col("node").alias("_m"), F.col("label").alias("_k"))
    between = links.join(own, F.col("a") == F.col("_n")).join(other, F.col("b") == F.col("_m")).select(
        F.col("_l").alias("a"), F.col("_k").alias("b")).where("a <> b")
    if between.isEmpty():
        return labels
    joined = components(between).select(F.col("node").alias("_n"), F.col("label").alias("_to"))
    return cut_lineage(labels.join(joined, F.col("label") == F.col("_n"), "left").select(
        "node", F.coalesce("_to", "label").alias("label")))


def _small(rows: DataFrame) -> DataFrame:
    """Rows of stored numbers, sent to every task if they are few, so that wide rows to be joined with them stay where they are."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _both(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """a, b and their sets x and y: only sets of ``pairs`` are dealt out."""
    pairs = _small(cut_lineage(pairs.select("a", "b")))
    ends = _small(cut_lineage(pairs.select(F.col("a").alias("node")).distinct()))
    x = full.select(F.col("node").alias("b"), F.col("items").alias("y"))
    y = full.join(ends, "node", "left_semi").select(F.col("node").alias("a"), F.col("items").alias("x"))
    return x.join(pairs, "b").join(y, "a").select("a", "b", "x", "y")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, text of the row (doc_id, content) that stands for each set of ``wanted``, one row a node."""
    rows = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    rows = rows.select(F.col("node"), F.col("doc_id").alias("_d"), F.col("content").alias("_c"))
    return docs.join(rows, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("content") == F.col("_c"))).select("node", "text")


def _grouped(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, content, n_shingles, key, component_id, kept for every document; key is the digest of its set."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", content_key(F.col("text")).alias("content"))
    sketch = cut_lineage(docs.mapInArrow(
        _sketch(width, BANDS, ROWS, SIZE), "doc_id long, content long, n long, key binary, bands array<long>, sign binary"))
    sets = sketch.where("key is not null").groupBy("key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "content")).alias("head"), F.first("bands").alias("bands"))
    sets = cut_lineage(sets.withColumn("rep", F.monotonically_increasing_id()))  # stored: every reader sees the same numbers
    members = cut_lineage(buckets(sets))
    wanted = cut_lineage(members.select("rep").distinct())
    # signatures are looked up for sets that meet others, and join the members of open buckets only
    named = sets.select("key", "rep").join(_small(wanted), "rep").select(F.col("key").alias("_key"), "rep")
    signs = sketch.join(_small(cut_lineage(named)), F.col("key") == F.col("_key")).groupBy("rep").agg(
        *[F.first(c).alias(c) for c in ("n", "sign", "bands")])
    signs = cut_lineage(signs)
    heads = cut_lineage(wanted.join(sets.select(F.col("rep").alias("node"), "head.doc_id", "head.content"), F.col("rep") == F.col("node"))
                        .select("node", "doc_id", "content"))
    again = heads.join(sketch.groupBy(F.col("doc_id").alias("_d"), F.col("content").alias("_c")).agg(F.count(F.lit(1)).alias("n")).where("n > 1"),
                       F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("content") == F.col("_c")), "left_semi")
    texts = _texts(docs, heads)
    texts = texts if again.isEmpty() else texts.dropDuplicates(["node"])  # repeated rows
    full = cut_lineage(texts.mapInArrow(_sets(width), "node long, items binary"))
    labels = cut_lineage(wanted.select(F.col("rep").alias("node"), F.col("rep").alias("label")))
    key = ["band", "hash", "lo", "hi"]

    def settled(rows, task, schema):
        return cut_lineage(rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(task, schema).distinct())

    rows = members.withColumn("label", F.col("rep")).join(signs, "rep").select(*key, *SHOWN)
    found = settled(rows, _candidates(percent), "a long, b long, band int, hash long")
    links = cut_lineage(_both(found.where("a is not null"), full).mapInArrow(_confirm(percent), "a long, b long"))
    labels = _joined(labels, links)
    more = found.where("a is null").select("band", "hash")
    if not more.isEmpty():  # buckets whose members are all joined need no more comparisons
        rows = members.join(_small(cut_lineage(more)), ["band", "hash"], "left_semi").join(labels, F.col("rep") == F.col("node"))
        rows = cut_lineage(rows.select(*key, "block", "rep", "label"))
        apart = rows.groupBy("band", "hash").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi")).where("_lo < _hi")
        rows = rows.join(apart.select("band", "hash"), ["band", "hash"], "left_semi").join(signs, "rep").select(*key, *SHOWN)
        rest = settled(rows, _open(percent), "band int, hash long, rep long, n long")
        rest = _dealt(rest, F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / ITEMS)).drop("n")
        rest = rest.join(labels, F.col("rep") == F.col("node")).join(signs, "rep")
        rest = rest.join(full.select(F.col("node").alias("rep"), "items"), "rep").select(*key, *SHOWN, "items")
        labels = _joined(labels, settled(rest, _links(percent), "a long, b long"))
    own = sets.select("rep", "key", F.struct("head.last", "head.doc_id", "key").alias("head")).join(
        labels, F.col("rep") == F.col("node"), "left").withColumn("label", F.coalesce("label", "rep"))
    own = cut_lineage(own.select("key", "label", "head"))
    best = own.groupBy(F.col("label").alias("_l")).agg(F.min("head").alias("best"))
    own = own.join(best, F.col("label") == F.col("_l")).select(F.col("key").alias("_key"), "best")
    out = sketch.select("doc_id", "content", "n", "key").join(own, F.col("key") == F.col("_key"), "left")
    kept = F.col("key").isNull() | ((F.col("key") == F.col("best.key")) & F.col("doc_id").eqNullSafe(F.col("best.doc_id")))
    return out.select("doc_id", "content", F.col("n").alias("n_shingles"), "key", F.when(
        F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("component_id"), kept.alias("kept"))


def group(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document."""
    return _grouped(docs, width, percent).drop("content", "key")


def keep_one(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One document of each group, the one of the smallest doc_id; of its rows with that doc_id and equal sets, the one with
    the smallest hash of the text stays.  Rows without words stay, equal ones of one doc_id once."""
    rows = cut_lineage(_grouped(docs, width, percent).drop("n_shingles"))
    first = rows.where("kept and key is not null").groupBy("doc_id", "key").agg(F.min("content").alias("_first"), F.max("content").alias("_other"))
    first = first.where("_first < _other").select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), "_first")
    less = rows.where("kept").join(first, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("key") == F.col("_k"))).where("content > _first")
    gone = rows.where("not kept").select("doc_id", "content").unionByName(less.select("doc_id", "content")).distinct()
    key = {"doc_id": F.col("doc_id").cast("long"), "content": content_key(F.col("text"))}
    left = matching(docs, gone, key, "left_anti")
    again = rows.where("kept and (key is not null or doc_id is not null)").groupBy("doc_id", "content").agg(F.count(F.lit(1)).alias("n"))
    again = cut_lineage(again.where("n > 1").select("doc_id", "content"))
    if again.isEmpty():
        return left
    return matching(left, again, key, "left_anti").unionByName(
        matching(left, again, key, "left_semi").dropDuplicates(["doc_id", "text"]))


def op9_neardup(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return group(table(spark, sf_dir, "documents"))
