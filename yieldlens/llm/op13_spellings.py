"""Spelling variant grouping: words one edit apart, found by scanning sorted lists with reused edit-matrix rows.

1. Words are the maximal letter runs of all texts, lower-cased in A-Z, with the stated deletions; those of ``SHORTEST`` code
   points and ``LEAST`` occurrences or more are the vocabulary, counted by Spark over all documents.
2. Two words one edit apart are equal but for one place p, the length of their common prefix.  The places 0..c of a
   pair whose shorter word has c code points are cut into ``HOLES`` ranges; a word is filed once for every range, under what
   it holds before and after that range, so that both words of a pair meet in the one list of the range that holds p.
   A list with more than ``LIST`` words has its range halved and its words filed again, until the lists are short or the range
   is one place (then it holds at most what one or two letters can make).  Numbers of words come from partial counts; no list
   is gathered before its length is known.
3. Inside a list, which is sorted, every word is compared with all words after it by the banded edit matrix (three columns,
   values up to 2).  Rows of the matrix belong to prefixes: the next word starts from the row of the prefix it shares with the
   one before, and when a row holds no value below 2 all words with that prefix are skipped at once.  The three
   values of a row are one number, a row's successor comes from a table, and all words of many lists advance together in numpy.
4. Each list gives, for a word, the number of its near words there and the best of them; Spark adds up and takes the best.
   Roots follow by pointer doubling: n grows tenfold with each form, so there are at most 18 steps and 6 rounds.

Memory of a task: one block of lists, ``CELLS`` code points, or one list of at most LIST words.  Executors may be lost: all
intermediate results are tables in the shared folder.

Cases.  Null text has no words; a null doc_id counts as the empty text before the colon; repeated rows count as
often as they occur; equal n among near words: the smallest in code-point order is the form.  Words may have any length.  An empty
table gives an empty result.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .text import BROADCAST_ROWS, table

SHORTEST = 7
LEAST = 2
RATIO = 10
EVERY = 31
HOLES = 4
LIST = 256
CELLS = 1 << 21
LETTER = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _succeeding() -> np.ndarray:
    """The row after a row: [9 a + 3 b + c, equalities] for the values a, b, c of columns i - 1, i, i + 1 of row i, capped at 2,
    and three bits that tell whether the next letter equals the query's at i - 1, i and i + 1."""
    out = np.zeros((27, 8), np.uint8)
    for row in range(27):
        a, b, c = row // 9, row // 3 % 3, row % 3
        for bits in range(8):
            differs = [1 - (bits >> k & 1) for k in range(3)]
            first = min(b + 1, a + differs[0], 2)
            second = min(c + 1, first + 1, b + differs[1], 2)
            third = min(second + 1, c + differs[2], 2)
            out[row, bits] = 9 * first + 3 * second + third
    return out


FIRST_ROW, OWN_ROW, DEAD = 9 * 2 + 1, 9 * 1 + 1, 26  # (2, 0, 1): nothing read; (1, 0, 1): the query's own prefix; (2, 2, 2)


def _matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, a row each between one zero before and two after, and their lengths."""
    lengths = np.array([len(w) for w in words], np.int64)
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    out = np.zeros((len(words), int(lengths.max(initial=0)) + 3), np.uint32)
    at = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(np.arange(len(words)), lengths), at + 1] = points
    return out, lengths


def _shared(points: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of rows a and b."""
    differs = points[a, 1:] != points[b, 1:]
    differs[:, -1] = True
    return np.minimum(differs.argmax(1), np.minimum(lengths[a], lengths[b]))


def near_pairs(words: list[str], lists: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (a, b), a < b, of rows of one list whose words are exactly one edit apart, and their common prefixes' lengths.

    ``lists`` numbers the lists in ascending order; words are sorted within a list and differ by at most one in length."""
    n = len(words)
    points, lengths = _matrix(words)
    rows = np.arange(n - 1)
    lcp = np.full(n, -1, np.int64)  # with the next word; -1 at the end of a list
    same = np.nonzero(lists[:-1] == lists[1:])[0]
    for s in range(0, len(same), 1 << 16):
        part = rows[same[s : s + (1 << 16)]]
        lcp[part] = _shared(points, part, part + 1, lengths)
    after = np.empty((points.shape[1], n), np.int32)  # [d, r]: the first row after r that does not share r's first d letters
    for d in range(points.shape[1]):
        ends = np.where(lcp < d, np.arange(1, n + 1, dtype=np.int32), n)
        after[d] = np.minimum.accumulate(ends[::-1])[::-1]
    succeeding = _succeeding()
    stack = np.full((n, points.shape[1]), OWN_ROW, np.uint8)  # [query, d]: the row after d letters of the current word
    stack[:, 0] = FIRST_ROW
    query = np.nonzero(lcp >= 0)[0]
    word, depth = query + 1, lcp[query]
    found = []
    while len(query):
        whole = depth == lengths[word]
        if whole.any():
            # column len(query) of row len(word): 0 for the column before, 1 for the same, 2 for the one after
            row = stack[query[whole], depth[whole]].astype(np.int64)
            column = lengths[query[whole]] - depth[whole] + 1
            value = np.choose(np.clip(column, 0, 2), [row // 9, row // 3 % 3, row % 3])
            hit = (value == 1) & (column >= 0) & (column <= 2)
            found.append(np.stack([query[whole][hit], word[whole][hit]]))
        letter = points[word, np.minimum(depth + 1, points.shape[1] - 1)]
        bits = (letter == points[query, depth]) + 2 * (letter == points[query, depth + 1]) + 4 * (
            letter == points[query, np.minimum(depth + 2, points.shape[1] - 1)])
        row = succeeding[stack[query, depth], bits]
        go = ~whole & (row != DEAD)
        stack[query[go], depth[go] + 1] = row[go]
        # a whole word moves on by one; a dead row skips all words that share it
        skip = np.where(whole, word + 1, after[np.minimum(depth + 1, points.shape[1] - 1), word])
        depth = np.where(go, depth + 1, lcp[skip - 1])
        word = np.where(go, word, skip)
        left = depth >= 0  # beyond the end of its list
        query, word, depth = query[left], word[left], depth[left]
    a, b = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    return a, b, _shared(points, a, b, lengths)


def _scan(batches):
    """Task function over rows (c, lo, hi, key, word, n) sorted by all of them: word, near words, best n, best word."""
    import pyarrow as pa

    def block(t):
        c, lo, hi, key = (t.column(k).to_numpy() for k in ("c", "lo", "hi", "key"))
        n = t.column("n").to_numpy()
        words = t.column("word").to_pylist()
        new = np.ones(len(words), bool)
        new[1:] = (c[1:] != c[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]) | (key[1:] != key[:-1])
        a, b, place = near_pairs(words, np.cumsum(new))
        lengths = np.array([len(w) for w in words])
        own = (np.minimum(lengths[a], lengths[b]) == c[a]) & (lo[a] <= place) & (place < hi[a])
        src, dst = np.concatenate([a[own], b[own]]), np.concatenate([b[own], a[own]])
        order = np.lexsort((dst, -n[dst], src))
        src, dst = src[order], dst[order]
        which, first, count = np.unique(src, return_index=True, return_counts=True)
        best = dst[first]
        return pa.RecordBatch.from_arrays(
            [pa.array([words[i] for i in which], pa.string()), pa.array(count, pa.int64()), pa.array(n[best], pa.int64()),
             pa.array([words[i] for i in best], pa.string())], names=["word", "near", "best_n", "best"])

    def last_list(t):
        """Row at which the last list of a table starts."""
        changed = np.zeros(t.num_rows, bool)
        for k in ("c", "lo", "hi", "key"):
            v = t.column(k).to_numpy()
            changed[1:] |= v[1:] != v[:-1]
        return int(np.nonzero(changed)[0].max(initial=0))

    held, cells = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        cells += batch.num_rows * (int(batch.column(0).to_numpy().max()) + 4)
        if cells > CELLS:
            t = pa.Table.from_batches(held).combine_chunks()
            cut = last_list(t)
            if cut:
                yield block(t.slice(0, cut))
                rest = t.slice(cut)
                held, cells = rest.to_batches(), rest.num_rows * (int(rest.column("c").to_numpy().max()) + 4)
    if held:
        yield block(pa.Table.from_batches(held).combine_chunks())


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, every: int = EVERY) -> DataFrame:
    """word, n of all documents, with the stated deletions."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"),
                       F.explode(F.regexp_extract_all("text", F.lit(f"({LETTER}{{{shortest},}})"), F.lit(1))).alias("_run"))
    ascii_only = F.octet_length("_run") == F.length("_run")
    lowered = runs.select("_id", F.when(ascii_only, F.lower("_run")).otherwise(F.translate("_run", UPPER, LOWER)).alias("_low"))
    h = F.crc32(F.concat("_id", F.lit(":"), "_low").cast("binary"))
    hashed = lowered.select("_low", h.alias("_h"))
    at = (F.col("_h") % F.length("_low")).cast("int")
    cut = F.concat(F.substring("_low", F.lit(1), at), F.substring("_low", at + 2, F.length("_low")))
    words = hashed.select(F.when(F.col("_h") % every == 0, cut).otherwise(F.col("_low")).alias("word"))
    return words.where(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def _filed(rows: DataFrame, holes: Column) -> DataFrame:
    """(c, lo, hi, key, word, n): a row of (word, n, c) for each of its ``holes`` (lo, hi), under the text around the hole."""
    return rows.select("word", "n", "c", F.explode(holes).alias("hole")).select(
        "c", F.col("hole.lo").alias("lo"), F.col("hole.hi").alias("hi"),
        F.xxhash64(F.left("word", F.col("hole.lo")), F.lit("/"),
                   F.right("word", F.greatest(F.col("c") - F.col("hole.hi"), F.lit(0)))).alias("key"), "word", "n")


def _hole(lo: Column, hi: Column) -> Column:
    return F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))


def near_words(vocab: DataFrame, shortest: int = SHORTEST, limit: int = LIST) -> DataFrame:
    """word, n_near, best_n, best of all words of a stored vocabulary that have a near word; best has the largest n."""
    length = F.length("word")
    both = F.when(length > shortest, F.array(length, length - 1)).otherwise(F.array(length))
    places = F.col("c") + 1
    quarters = F.array(*[_hole(F.floor(places * i / HOLES), F.floor(places * (i + 1) / HOLES)) for i in range(HOLES)])
    rows = _filed(vocab.select("word", "n", F.explode(both).alias("c")), quarters)
    parts = None
    file = ["c", "lo", "hi", "key"]
    while rows is not None:
        rows = cut_lineage(rows)
        long = (F.col("_size") > limit) | (F.col("_size") * F.col("c") > CELLS)
        sizes = rows.groupBy(*file).agg(F.count(F.lit(1)).alias("_size")).where(long & (F.col("hi") - F.col("lo") > 1))
        sizes = cut_lineage(sizes.select(*file))
        number = sizes.count()
        short = rows
        if number:
            marks = F.broadcast(sizes) if number <= BROADCAST_ROWS else sizes
            short = rows.join(marks, file, "left_anti")
        scanned = short.repartition(*file).sortWithinPartitions(*file, "word").mapInArrow(
            _scan, "word string, near long, best_n long, best string")
        parts = scanned if parts is None else parts.unionByName(scanned)
        if number:
            mid = F.floor((F.col("lo") + F.col("hi")) / 2)
            again = rows.join(marks, file, "left_semi").withColumn("_halves", F.array(_hole(F.col("lo"), mid), _hole(mid, F.col("hi"))))
            rows = _filed(again, F.col("_halves"))
        else:
            rows = None
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    return parts.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("_b")).select(
        "word", "n_near", (-F.col("_b.less")).alias("best_n"), F.col("_b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root of stored (word, form) links, following them to the last by pointer doubling."""
    links = forms.select("word", F.col("form").alias("root"))
    while True:
        further = links.select(F.col("word").alias("_via"), F.col("root").alias("_next"))
        links = cut_lineage(links.join(further, F.col("root") == F.col("_via"), "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")))
        if not links.where("moved").limit(1).count():
            return links.drop("moved")
        links = links.drop("moved")


def group(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, ratio: int = RATIO, limit: int = LIST) -> DataFrame:
    """word, form, root, n, n_near, form_n of all words of the documents."""
    vocab = cut_lineage(vocabulary(docs, shortest, least))
    near = near_words(vocab, shortest, limit)
    takes = F.col("best_n") >= ratio * F.col("n")
    known = cut_lineage(vocab.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(takes, F.col("best")).alias("form"), F.when(takes, F.col("best_n")).alias("form_n")))
    last = roots(known.where(F.col("form").isNotNull()).select("word", "form"))
    return known.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spellings(spark, sf_dir: str) -> DataFrame:
    """Forms and roots of all words of all documents."""
    return group(table(spark, sf_dir, "documents"))


#: The same in DuckDB: CRC-32 byte by byte, words one edit apart by equal texts around one place.
SQL = f"""WITH RECURSIVE
  bits AS (SELECT list(list_reduce(range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i)
      ORDER BY i) AS t FROM range(256) AS r(i)),
  runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(run, '{UPPER}', '{LOWER}') AS low, count(*) AS k
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) WHERE length(run) >= {SHORTEST}
    GROUP BY 1, 2),
  bytes AS (SELECT low, k, list_transform(range(0, length(x) // 2), lambda i:
      CAST((strpos('0123456789ABCDEF', x[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', x[2 * i + 2]) - 1 AS BIGINT)) AS b
    FROM (SELECT low, k, hex(id || ':' || low) AS x FROM runs)),
  hashed AS (SELECT low, k, xor(list_reduce(b, lambda c, v: xor(c >> 8, t[xor(c, v) % 256 + 1]), 4294967295), 4294967295) AS h
    FROM bytes, bits),
  v AS MATERIALIZED (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (SELECT k, CASE WHEN h % {EVERY} = 0
      THEN substring(low, 1, h % length(low)) || substring(low, h % length(low) + 2) ELSE low END AS word FROM hashed)
    WHERE length(word) >= {SHORTEST} GROUP BY word HAVING sum(k) >= {LEAST}),
  holes AS MATERIALIZED (SELECT word, p, substring(word, 1, p) || substring(word, p + 2) AS rest
    FROM (SELECT word, unnest(range(length(word))) AS p FROM v)),
  pairs AS (SELECT x.word AS a, y.word AS b FROM holes x JOIN holes y ON x.p = y.p AND x.rest = y.rest AND x.word <> y.word
    UNION SELECT h.word, v.word FROM holes h JOIN v ON h.rest = v.word
    UNION SELECT v.word, h.word FROM holes h JOIN v ON h.rest = v.word),
  near AS (SELECT a, count(*) AS n_near, arg_min(b, (-v.n, b)) AS best, max(v.n) AS best_n FROM pairs JOIN v ON v.word = b GROUP BY a),
  known AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= {RATIO} * v.n THEN best END AS form,
      CASE WHEN best_n >= {RATIO} * v.n THEN best_n END AS form_n FROM v LEFT JOIN near ON near.a = v.word),
  up AS (SELECT word, word AS at FROM known UNION ALL SELECT up.word, known.form FROM up JOIN known ON known.word = up.at
    WHERE known.form IS NOT NULL)
  SELECT known.word, known.form, up.at AS root, known.n, known.n_near, known.form_n
  FROM known JOIN up ON up.word = known.word JOIN known last ON last.word = up.at AND last.form IS NULL"""
