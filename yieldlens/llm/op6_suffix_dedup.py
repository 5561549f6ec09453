"""Removal of repeated byte strings by blockwise suffix sorting with a difference-cover sample.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier (smaller document, or earlier in the same
one).  Strings are suffixes cut at that length; equal ones must meet in one place without moving every suffix.

1. Later exact copies of a text go whole: all their strings start earlier, and no other verdict depends on them.
2. Anchors: in every string the ``ANCHOR`` bytes with the smallest hash are its anchor, at the same place in equal
   strings.  Anchor hashes are counted over all documents; a suffix whose anchor occurs once is unique and is done.
3. Buckets: the suffixes of one shared anchor are a bucket.  A row carries a run of suffixes with the bytes they span;
   buckets are dealt over the tasks and a task sorts some of them at a time.
4. In a bucket all suffixes are aligned on the anchor, so the cover sample of every ``STEP``-th place (difference 0
   modulo STEP is the only one that can occur) gets ranks from one sort of the sampled strings.  A suffix is then placed
   by the rank of the first sample at or after its start, the fewer than STEP bytes before it and the fewer than STEP
   bytes past the sampled string: ties of any length are settled by the ranks.  Nothing is hashed here: results are exact
   up to the anchor filter, which can only let more suffixes through.

Cases: null text is empty; texts shorter than a string are kept whole; rows that repeat doc_id and text share one
verdict (they are the same document), rows that repeat doc_id with other text are ordered by start within the
doc_id; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import BASE, INVERSE, mixed, powers, slices, table, utf8

LENGTH = 100
ANCHOR = 32
STEP = 8
SLICE = 1 << 20    # bytes of text worked on at a time
BLOCK = 40_000     # rows of suffix runs that are sorted at a time
BUCKET_BYTES = 1 << 24  # text whose anchors make one bucket, up to MAX_BUCKETS
MAX_BUCKETS = 20_000
SEEN = 200_000     # runs that a task remembers, to settle repeats before they are shuffled
NO_ID = -(1 << 63)  # a null doc_id orders before all others


def anchors(data, offsets, length: int, anchor: int):
    """(row, place, hash, first, last) arrays: the anchors of all strings of some texts, with the starts of the strings
    that each is the anchor of.

    Hashes of all ``anchor``-byte pieces come from one running sum; the leftmost smallest one of each string from
    minima over spans that double."""
    import numpy as np

    n, reach = len(data), length - anchor + 1
    empty = np.empty(0, np.int64)
    if n < length:
        return empty, empty, np.empty(0, np.uint64), empty, empty
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=total[1:])
    pieces = mixed((total[anchor:] - total[:-anchor]) * powers(INVERSE, n - anchor + 1))
    low, at, span = pieces, np.arange(len(pieces), dtype=np.int32), 1

    def joined(shift):
        right = low[shift:] < low[: len(low) - shift]
        return np.where(right, low[shift:], low[: len(low) - shift]), np.where(right, at[shift:], at[: len(at) - shift])

    while span * 2 <= reach:
        low, at = joined(span)
        span *= 2
    if reach > span:
        low, at = joined(reach - span)
    starts = np.arange(len(at))
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(at)]
    valid = starts + length <= offsets[1:][row]
    starts, row, place = starts[valid], row[valid], at[valid].astype(np.int64)
    if not len(starts):
        return empty, empty, np.empty(0, np.uint64), empty, empty
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    first = np.nonzero(new)[0]
    last = np.append(first[1:], len(starts)) - 1
    row, place = row[first], place[first]
    base = offsets[row]
    return row, place - base, pieces[place], starts[first] - base, starts[last] - base


def _emit_anchors(length: int, anchor: int, buckets: int):
    """Anchors of each batch as one row for each bucket; texts that the batch repeats count once."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            th = batch.column("th").to_numpy(zero_copy_only=False)
            _, once = np.unique(th, return_index=True)
            texts, th = batch.column("text").take(pa.array(np.sort(once))), th[np.sort(once)]
            data, offsets = utf8(texts)
            names, places, hashes = [], [], []
            for a, b in slices(offsets, SLICE):
                row, place, h, _, _ = anchors(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], length, anchor)
                names.append(th[a:b][row])
                places.append(place.astype(np.int32))
                hashes.append(h)
            if not names:
                continue
            name, place, h = np.concatenate(names), np.concatenate(places), np.concatenate(hashes)
            bucket = (h % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            held, start = np.unique(bucket[order], return_index=True)
            end = np.append(start[1:], len(order))
            part = lambda x: pa.array([x[order[i:j]].tobytes() for i, j in zip(start, end)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), part(h), part(name), part(place)],
                                             names=["bucket", "hashes", "names", "places"])

    return run


def _shared_places():
    """th, place of every anchor whose hash has two places or more; rows arrive sorted by bucket, one is held."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def settle(rows):
            h, name, place = (np.frombuffer(b"".join(r[k] for r in rows), t) for k, t in enumerate((np.uint64, np.int64, np.int32)))
            order = np.lexsort((place, name, h))
            h, name, place = h[order], name[order], place[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (name[1:] != name[:-1]) | (place[1:] != place[:-1])
            h, name, place = h[new], name[new], place[new]
            many = np.zeros(len(h), bool)
            many[1:] = h[1:] == h[:-1]
            many[:-1] |= many[1:]
            return pa.RecordBatch.from_arrays([pa.array(name[many]), pa.array(place[many])], names=["th", "place"])

        now, rows = None, []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("bucket", "hashes", "names", "places")]
            for bucket, *row in zip(*cols):
                if bucket != now and rows:
                    yield settle(rows)
                    rows = []
                now = bucket
                rows.append(row)
        if rows:
            yield settle(rows)

    return run


RUNS = "h long, id long, th long, first int, n int, off int, bytes binary"


def _runs(length: int, anchor: int):
    """The runs of suffixes under shared anchors, with the bytes they span.  Rows arrive sorted by id: a run that repeats
    an earlier one of this task byte for byte is settled here and goes on without bytes, under a key of its own."""
    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        seen = {}
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            ids, ths = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "th"))
            wanted = batch.column("places").to_pylist()
            for a, b in slices(offsets, SLICE):
                row, place, h, first, last = anchors(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], length, anchor)
                key = np.concatenate([np.unique(np.array(p, np.int64)) + (i << 40) for i, p in enumerate(wanted[a:b])])
                keep = np.isin(row * (1 << 40) + place, key)
                row, place, h, first, last = row[keep], place[keep], h[keep].view(np.int64).copy(), first[keep], last[keep]
                raw = []
                begin = offsets[a:b][row] + first
                for k, (s, n, off) in enumerate(zip(begin.tolist(), (last - first + length).tolist(), (place - first).tolist())):
                    piece = data[s : s + n].tobytes()
                    sign = hashlib.blake2b(piece, digest_size=12, salt=off.to_bytes(2, "little")).digest()
                    if len(seen) >= SEEN:
                        seen.clear()
                    me = (ids[a:b][row[k]], s - offsets[a + row[k]])
                    again = seen.setdefault(sign, me) != me
                    raw.append(None if again else piece)
                    if again:
                        h[k] = me[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), pa.array(ids[a:b][row]), pa.array(ths[a:b][row]), pa.array(first, pa.int32()),
                     pa.array(last - first + 1, pa.int32()), pa.array(place - first, pa.int32()), pa.array(raw, pa.binary())],
                    names=["h", "id", "th", "first", "n", "off", "bytes"])

    return run


def dense_ranks(keys):
    """Ranks (from 0) of rows by the keys, most significant first; equal rows share a rank."""
    import numpy as np

    order = np.lexsort(keys[::-1])
    step = np.zeros(len(order), bool)
    for k in keys:
        step[1:] |= k[order][1:] != k[order][:-1]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(step)
    return ranks


def _number(rows, a: int, b: int):
    """Columns a to b (at most 8) of a byte matrix as one big-endian number for each row."""
    import numpy as np

    out = np.zeros(len(rows), np.uint64)
    for c in range(a, b):
        out = out << np.uint64(8) | rows[:, c].astype(np.uint64)
    return out


def repeats(h, ids, first, n, off, raw, length: int, anchor: int):
    """Which suffixes of some runs repeat an earlier one: a row for each run, a column for each start, aligned on the
    anchor (column c is the string that starts ``reach - 1 - c`` bytes before it).  Runs must be in the order of (id, start)."""
    import numpy as np

    reach, sampled = length - anchor + 1, length - STEP + 1
    lead = reach - 1
    width = lead + length + 2 * STEP
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    text = np.zeros((len(raw), width), np.uint8)
    begin = lead - off
    flat = np.repeat(np.arange(len(raw)) * width + begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    text.reshape(-1)[flat] = np.frombuffer(b"".join(raw), np.uint8)
    flagged = np.zeros((len(raw), reach), bool)
    for c in range(0, lead + STEP, STEP):
        using = np.nonzero((begin <= c) & (begin + n - 1 > c - STEP))[0]
        if len(using) < 2:
            continue
        rows = text[using]
        words = [_number(rows, k, min(k + 8, c + sampled)) for k in range(c, c + sampled, 8)]
        rank = dense_ranks([h[using], *words])
        some = np.bincount(rank)[rank] > 1       # a sampled string of its own ends the matter
        using, rows, rank = using[some], rows[some], rank[some]
        for s in range(max(0, c - STEP + 1), min(c, lead) + 1):
            at = np.nonzero((begin[using] <= s) & (begin[using] + n[using] > s))[0]
            if len(at) < 2:
                continue
            keys = [rank[at], _number(rows[at], s, c), _number(rows[at], c + sampled, s + length)]
            order = np.lexsort(keys[::-1])        # stable: equal strings stay in the order of (id, start)
            new = np.zeros(len(order), bool)
            new[0] = True
            for k in keys:
                new[1:] |= k[order][1:] != k[order][:-1]
            run = using[at[order]]
            head = run[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
            earlier = (ids[head] != ids[run]) | (first[head] + off[head] != first[run] + off[run])
            flagged[run[earlier], s] = True
    return flagged


def _settle(length: int, anchor: int):
    """id, th and byte ranges to remove; rows arrive sorted by (h, id, first), whole buckets are sorted at a time.

    A bucket of more than BLOCK rows is taken in pieces: what the next piece has to know of the ones before are the
    runs with a string that was the first of its kind."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        reach = length - anchor + 1
        names = ["h", "id", "th", "first", "n", "off"]

        def ranges(rows, flagged):
            """The flagged starts of each run as byte ranges."""
            edge = np.zeros((len(flagged), reach + 1), bool)
            edge[:, 1:reach] = flagged[:, 1:] != flagged[:, :-1]
            edge[:, 0], edge[:, reach] = flagged[:, 0], flagged[:, -1]
            row, col = np.nonzero(edge)
            row, a, b = row[::2], col[::2], col[1::2]
            shift = rows["first"][row] + rows["off"][row] - (reach - 1)
            return pa.RecordBatch.from_arrays([pa.array(rows["id"][row]), pa.array(rows["th"][row]), pa.array((a + shift).astype(np.int32)),
                                               pa.array((b - 1 + shift + length).astype(np.int32))], names=["id", "th", "a", "e"])

        def block(held, raw, carried):
            """Rate rows (sorted by h, id, first) that follow ``carried`` ones; returns the ranges and what to carry on."""
            rows = {k: np.concatenate([carried[0][k], held[k]]) if carried else held[k] for k in names}
            every = (carried[1] if carried else []) + raw
            flagged = repeats(rows["h"], rows["id"], rows["first"], rows["n"], rows["off"], every, length, anchor)
            old = len(carried[1]) if carried else 0
            keep = np.nonzero(flagged.sum(1) < rows["n"])[0]
            on = ({k: v[keep] for k, v in rows.items()}, [every[i] for i in keep])
            return ranges({k: v[old:] for k, v in rows.items()}, flagged[old:]), on

        held, raw, carried = {k: np.empty(0, np.int64) for k in names}, [], None
        for batch in _ended(batches):
            if batch is not None:
                cols = {k: batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in names}
                sent = batch.column("bytes")
                done = sent.is_null().to_numpy(zero_copy_only=False)
                if done.any():
                    part = {k: v[done] for k, v in cols.items()}
                    full = (np.arange(reach) >= (reach - 1 - part["off"])[:, None]) & (np.arange(reach) < (reach - 1 - part["off"] + part["n"])[:, None])
                    yield ranges(part, full)
                held = {k: np.concatenate([held[k], v[~done]]) for k, v in cols.items()}
                raw = raw + sent.filter(pa.array(~done)).to_pylist()
            while len(raw) > BLOCK or batch is None and raw:
                to = len(raw) if batch is None and len(raw) <= BLOCK else BLOCK
                if to < len(raw):  # end with a bucket if one ends in here
                    cut = int(np.searchsorted(held["h"], held["h"][to], "left"))
                    to = cut or to
                if carried and carried[0]["h"][0] != held["h"][0]:
                    carried = None
                now = {k: v[:to] for k, v in held.items()}
                if carried:  # only rows of the bucket that goes on may be sorted with the carried ones
                    to = min(to, int(np.searchsorted(now["h"], carried[0]["h"][0], "right")))
                    now = {k: v[:to] for k, v in held.items()}
                out, on = block(now, raw[:to], carried)
                yield out
                rest = held["h"][to : to + 1]
                carried = None
                if len(rest) and now["h"][-1] == rest[0] or not len(rest) and batch is not None:
                    same = on[0]["h"] == now["h"][-1]
                    carried = ({k: v[same] for k, v in on[0].items()}, [r for r, s in zip(on[1], same) if s]) if same.any() else None
                held, raw = {k: v[to:] for k, v in held.items()}, raw[to:]

    return run


def _ended(batches):
    """The batches, then None."""
    yield from batches
    yield None


def _remove(length: int):
    """Digest columns of each text less its ranges."""
    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
            for i, spans in enumerate(batch.column("spans").to_pylist()):
                text = data[offsets[i] : offsets[i + 1]]
                size, gone, runs, at, kept = len(text), 0, 0, 0, hashlib.sha256()
                for s in sorted((s["a"], s["e"]) for s in spans or ()):
                    a, e = s[0], min(s[1], size)
                    if e <= at and runs:
                        continue
                    if a > at or not runs:
                        kept.update(text[at:a].tobytes())
                        runs += 1
                        at = a
                    gone += e - at
                    at = e
                kept.update(text[at:].tobytes())
                for k, v in zip(out, (size, gone, runs, kept.hexdigest())):
                    out[k].append(v)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array(v, pa.string() if k == "kept_sha256" else pa.int64())
                                                                   for k, v in out.items()]], names=["id", *out])

    return run


def repeated_ranges(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[DataFrame, DataFrame]:
    """(texts, ranges): id, th, text of every document, and id, th, a, e of the byte ranges to remove."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
                        F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), F.coalesce("text", F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(min(size // BUCKET_BYTES, MAX_BUCKETS)))
    copies = texts.groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("sha"), "th").agg(F.min("id").alias("first"))
    own = texts.select("id", "th", F.sha2(F.col("text").cast("binary"), 256).alias("_sha"), F.octet_length("text").alias("e"))
    later = own.where(F.col("e") >= length).join(copies.select("sha", "first"), F.col("_sha") == F.col("sha")).where(
        F.col("id") != F.col("first")).select("id", "th", F.lit(0).alias("a"), "e")
    places = (texts.select("th", "text").mapInArrow(_emit_anchors(length, anchor, parts), "bucket int, hashes binary, names binary, places binary")
              .repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_shared_places(), "th long, place int"))
    places = places.groupBy("th").agg(F.collect_list("place").alias("places"))  # of one text
    places = places.join(copies.select(F.col("th").alias("_th"), "first"), F.col("th") == F.col("_th")).select(
        F.col("first").alias("_id"), "_th", "places")
    met = texts.join(places, (F.col("id") == F.col("_id")) & (F.col("th") == F.col("_th"))).select("id", "th", "text", "places")
    runs = met.sortWithinPartitions("id").mapInArrow(_runs(length, anchor), RUNS)
    found = (runs.repartition(parts, "h").sortWithinPartitions("h", "id", "first")
             .mapInArrow(_settle(length, anchor), "id long, th long, a int, e int"))
    return texts, found.unionByName(later)


def remove_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every document."""
    texts, ranges = repeated_ranges(docs, length, anchor)
    spans = ranges.groupBy(F.col("id").alias("_id"), F.col("th").alias("_th")).agg(
        F.collect_set(F.struct("a", "e")).alias("spans"))  # of one document
    rows = texts.join(spans, (F.col("id") == F.col("_id")) & (F.col("th") == F.col("_th")), "left").select("id", "text", "spans")
    schema = T.StructType([T.StructField("id", T.LongType())] + [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
                          + [T.StructField("kept_sha256", T.StringType())])
    out = rows.mapInArrow(_remove(length), schema)
    return out.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document less the bytes of strings of 100 bytes that start earlier somewhere."""
    return remove_repeats(table(spark, sf_dir, "documents"))
