"""Token-ID output: frequency-ranked ids in byte-aligned variable-length codes with separate control bytes.

File format: a Parquet table in the shared folder, one row for each document in ascending doc_id order (null
first), dealt to shards by range of doc_id.  A row holds its shard, the ids of the shard's documents before it, the
number of ids, the control bytes (two bits for each id: the length of its code less one, four ids to a byte, first id
lowest) and the codes (1 to 4 bytes, little-endian) of the ids' frequency ranks.  The rank table of one file is a
second small table, one row for each id of the vocabulary.  Spark's commit protocol decides which task's rows count,
so a lost executor only costs its tasks.

Bounds: the vocabulary's size bounds the frequency table, the only thing that passes the driver; MAX_SHARDS bounds the
table of shard totals.

Cases: null text is empty and gives the end id alone; a repeated doc_id keeps one row for each of its rows, ordered by
a hash of the text; a text of any length is cut where no token of this tokenizer crosses, so its
words are encoded once each; an empty table gives an empty file; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, shared_path
from .text import slices, table, utf8

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
TOKENS_PER_SHARD = 8_000_000
MAX_SHARDS = 10_000
SLICE_BYTES = 3 << 20     # text encoded at a time
GROUP_IDS = 1 << 19       # ids packed or unpacked at a time
TABLE_BYTES = 64 << 20    # beyond this a worker's table of encoded parts keeps its most used third
PART_BYTES = 130          # what a part takes in the table beside its string
JOINED = 256              # new words encoded as one text


def load_tokenizer(path: str):
    """The tokenizer of a file; a bare name is looked up among the installed public tokenizers."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    if "/" not in path:
        import public_tokenizers

        path = public_tokenizers.path(path)
    return Tokenizer.from_file(path)


def ranges(start, length):
    """The indices start[0], start[0] + 1, ... of all ranges one after another."""
    import numpy as np

    ends = np.cumsum(length)
    return np.repeat(start - ends + length, length) + np.arange(int(ends[-1]) if len(ends) else 0)


#: What byte-level vocabularies write for a space.
SPACE_LETTER = "\u0120"
#: Two white-space characters in a row, for the two regular-expression libraries.
DOUBLE = r"[\t-\r \x{1c}-\x{1f}\x{85}\p{Z}]{2}"


class WordTable:
    """Ids of pieces of text already encoded.

    A text is cut at single spaces between two characters that are no white space: the tokenizer cuts there too (the
    space begins the next piece).  A piece is cut further at single line ends, which are tokens of their own, and before
    a final comma or full stop that follows a letter.  So a text's ids are those of its parts, and each different
    part is encoded once while it is remembered.  The table outlives a task (``worker_table``); it is bounded by bytes."""

    def __init__(self, tokenizer, end_id: int):
        import re

        import numpy as np

        self.tokenizer = tokenizer
        self.double, self.single, self.white = re.compile(r"\s\s"), re.compile(r"(?<!\s) (?!\s)"), re.compile(r"\s")
        size = max(tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
        self.opens = np.zeros(size, bool)  # the tokens that begin with a space
        for token, i in tokenizer.get_vocab(with_added_tokens=True).items():
            self.opens[i] = token.startswith(SPACE_LETTER)
        self.codes: dict[str, int] = {}   # of parts as they stand
        self.spaced: dict[str, int] = {}  # of words with the space before them
        self.flat, self.start, self.length = np.array([end_id], np.uint32), np.zeros(1, np.int64), np.ones(1, np.int64)
        self.uses, self.held = np.zeros(1, np.int32), 0

    def trim(self):
        """Forget all parts but the third that most slices used; the end's part stays the first."""
        import sys

        import numpy as np

        order = np.argsort(-self.uses[1:], kind="stable")[: len(self.uses) // 3] + 1
        keep = np.append(0, np.sort(order))
        code = np.full(len(self.start), -1)
        code[keep] = np.arange(len(keep))
        self.flat = self.flat[ranges(self.start[keep], self.length[keep])]
        self.length, self.uses = self.length[keep], self.uses[keep] // 2
        self.start = np.cumsum(self.length) - self.length
        code = code.tolist()
        self.codes = {k: code[c] for k, c in self.codes.items() if code[c] >= 0}
        self.spaced = {k: code[c] for k, c in self.spaced.items() if code[c] >= 0}
        self.held = sum(PART_BYTES + sys.getsizeof(k) for d in (self.codes, self.spaced) for k in d)

    def one_by_one(self, parts: list[str]):
        """Flat ids of parts and the number of each."""
        import itertools

        import numpy as np

        ids = [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(length.sum())), length

    def after_space(self, words: list[str]):
        """The same for words with a space before each.  Those without white space are encoded many in one text, where
        each begins at a token that begins with a space; if the numbers differ, they are encoded one by one."""
        import numpy as np

        alone = list(filter(self.white.search, words))
        if alone:
            at = np.fromiter((bool(self.white.search(w)) for w in words), bool, len(words))
            (a, n), (b, m) = (self.after_space([w for w, x in zip(words, at.tolist()) if not x]),
                              self.one_by_one([" " + w for w in alone]))
            length, start, flat = np.empty(len(words), np.int64), np.empty(len(words), np.int64), np.concatenate([a, b])
            length[~at], length[at] = n, m
            start[~at], start[at] = np.cumsum(n) - n, len(a) + np.cumsum(m) - m
            return flat[ranges(start, length)], length
        flat, _ = self.one_by_one([" " + " ".join(words[i : i + JOINED]) for i in range(0, len(words), JOINED)])
        begin = np.nonzero(self.opens[flat])[0]
        if len(begin) != len(words):
            return self.one_by_one([" " + w for w in words])
        return flat, np.diff(np.append(begin, len(flat)))

    def find(self, table: dict, keys: list[str], encode):
        """Codes of keys, new ones encoded first."""
        import itertools
        import sys

        import numpy as np

        codes = np.fromiter(map(table.get, keys, itertools.repeat(-1)), np.int64, len(keys))
        missing = np.nonzero(codes < 0)[0]
        if len(missing):
            new = list(dict.fromkeys([keys[i] for i in missing.tolist()]))
            flat, length = encode(new)
            table.update(zip(new, range(len(self.start), len(self.start) + len(new))))
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(length) - length])
            self.length = np.concatenate([self.length, length])
            self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int32)])
            self.flat = np.concatenate([self.flat, flat])
            self.held += sum(map(sys.getsizeof, new)) + PART_BYTES * len(new)
            codes[missing] = np.fromiter(map(table.__getitem__, [keys[i] for i in missing.tolist()]), np.int64, len(missing))
        self.uses[codes] += 1
        return codes

    def cut(self, piece: str) -> list[str]:
        """The parts of a piece that is no plain word."""
        if "\n" in piece and not self.double.search(piece):
            out = []
            for i, line in enumerate(piece.split("\n")):
                if i:
                    out.append("\n")
                if line:
                    out += self.cut(line)
            return out
        if piece[-1:] in (",", ".") and piece[-2:-1].isalpha():
            return [piece[:-1], piece[-1]]
        return [piece]

    def encode(self, texts):
        """Flat ids of an Arrow string column without nulls, each text closed by the end id, and the ids of each.

        Entries are the different words of the column, its texts' first pieces and the end; each has some parts."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        if self.held > TABLE_BYTES:
            self.trim()
        if pc.any(pc.match_substring_regex(texts, DOUBLE)).as_py():
            pieces = pa.array([self.single.split(t) if self.double.search(t) else t.split(" ") for t in texts.to_pylist()])
        else:
            pieces = pc.split_pattern(texts, " ")
        flat = pieces.flatten()
        bounds = np.append(0, np.cumsum(pc.list_value_length(pieces).to_numpy(zero_copy_only=False))).astype(np.int64)
        coded = flat.dictionary_encode()
        words = coded.dictionary
        plain = pc.invert(pc.match_substring(words, "\n"))
        tail = pc.and_(plain, pc.match_substring_regex(words, r"\p{L}[,.]$")).to_numpy(zero_copy_only=False)
        stems = pc.if_else(pa.array(tail), pc.utf8_slice_codeunits(words, 0, -1), words).filter(plain).dictionary_encode()
        plain = plain.to_numpy(zero_copy_only=False)
        stem = self.find(self.spaced, stems.dictionary.to_numpy(zero_copy_only=False).tolist(), self.after_space)[stems.indices.to_numpy(zero_copy_only=False)]
        other = [self.cut(" " + w) for w in words.filter(pa.array(~plain)).to_pylist()]
        other += [self.cut(w) for w in flat.take(pa.array(bounds[:-1])).to_pylist()]
        rest = self.find(self.codes, [p for c in other for p in c], self.one_by_one)
        comma, stop = self.find(self.codes, [",", "."], self.one_by_one)
        extra = np.fromiter(map(len, other), np.int64, len(other))
        many = np.concatenate([1 + tail, np.ones(len(texts) + 1, np.int64)])  # parts of each entry
        nests = np.append(np.nonzero(~plain)[0], len(words) + np.arange(len(texts)))
        many[nests] = extra
        begin = np.cumsum(many) - many
        part = np.zeros(int(many.sum()), np.int64)                            # the end's part is 0
        part[begin[: len(words)][plain]] = stem
        ends = pc.match_substring_regex(words.filter(pa.array(tail)), r",$").to_numpy(zero_copy_only=False)
        part[begin[: len(words)][tail] + 1] = np.where(ends, comma, stop)
        part[ranges(begin[nests], extra)] = rest
        pick = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        pick[bounds[:-1]] = len(words) + np.arange(len(texts))
        pick = np.insert(pick, bounds[1:], len(many) - 1)
        upto = np.append(0, np.cumsum(self.length[part]))
        size = upto[begin + many] - upto[begin]
        part = part[ranges(begin[pick], many[pick])]
        ids = self.flat[ranges(self.start[part], self.length[part])]
        return ids, np.add.reduceat(size[pick], bounds[:-1] + np.arange(len(texts)))


def worker_table(path: str, end_id: int) -> WordTable:
    """The table of this Python worker, which serves one task after another."""
    import sys
    import types

    kept = sys.modules.setdefault("_token_id_tables", types.ModuleType("_token_id_tables")).__dict__
    if (path, end_id) not in kept:
        kept[path, end_id] = WordTable(load_tokenizer(path), end_id)
    return kept[path, end_id]


def _tokenise(path: str, end_id: int, size: int, id_type: str):
    """Rows of ids; a task's last row has no ids but its count of each id."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        words = worker_table(path, end_id)
        total, types = np.zeros(size, np.int64), None
        names = ["doc_id", "tie", "n", "ids", "seen"]
        seen = pa.list_(pa.struct([pa.field("id", pa.int64()), pa.field("n", pa.int64())]))
        for batch in batches:
            types = [batch.schema.field("doc_id").type, batch.schema.field("tie").type]
            texts = batch.column("text").fill_null("")
            for at, to in slices(utf8(texts)[1], SLICE_BYTES):
                ids, n = words.encode(texts.slice(at, to - at))
                total += np.bincount(ids, minlength=size)
                data = ids.astype(id_type)
                ends = np.cumsum(n)
                raw = [data[e - k : e].tobytes() for e, k in zip(ends.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, to - at), batch.column("tie").slice(at, to - at),
                     pa.array(n, pa.int64()), pa.array(raw, pa.binary()), pa.nulls(to - at, seen)], names=names)
        if types:
            found = np.nonzero(total)[0]
            counts = pa.StructArray.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], ["id", "n"])
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, t) for t in types] + [pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                 pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), counts)], names=names)

    return run


def pack(ranks, counts) -> tuple[list[bytes], list[bytes]]:
    """Control bytes and codes of each of some rows of uint32, given one after another with their counts."""
    import numpy as np

    ranks = np.ascontiguousarray(ranks, np.dtype("<u4"))
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4, dtype=np.uint8) <= extra[:, None]]
    upto = np.append(0, np.cumsum(extra, dtype=np.int64) + np.arange(1, len(extra) + 1))
    ends = np.append(0, np.cumsum(counts))
    quads = (np.asarray(counts) + 3) // 4
    closes = np.append(0, np.cumsum(quads))
    two = np.zeros(4 * int(closes[-1]), np.uint8)
    two[ranges(4 * closes[:-1], np.asarray(counts))] = extra
    two = two.reshape(-1, 4)
    control = two[:, 0] | two[:, 1] << 2 | two[:, 2] << 4 | two[:, 3] << 6
    cut = lambda x, at: [x[i:j].tobytes() for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
    return cut(control, closes), cut(codes, upto[ends])


def unpack(control, codes, counts):
    """The values of some rows that ``pack`` made, one after another: lengths come from a table with a row for each
    possible control byte."""
    import numpy as np

    lengths = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8)
    counts = np.asarray(counts, np.int64)
    quads = (counts + 3) // 4
    extra = lengths[np.frombuffer(b"".join(control), np.uint8)].reshape(-1)[ranges(4 * (np.cumsum(quads) - quads), counts)]
    out = np.zeros((len(extra), 4), np.uint8)
    out[np.arange(4, dtype=np.uint8) <= extra[:, None]] = np.frombuffer(b"".join(codes), np.uint8)
    return out.view("<u4").reshape(-1)


def _groups(counts: list[int]):
    """Row ranges of about ``GROUP_IDS`` ids."""
    at, held = 0, 0
    for i, n in enumerate(counts):
        held += n
        if held >= GROUP_IDS:
            yield at, i + 1
            at, held = i + 1, 0
    if at < len(counts):
        yield at, len(counts)


def _encode(rank_of, id_type: str):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        before = 0
        for batch in batches:
            counts, raw = batch.column("n").to_pylist(), batch.column("ids").to_pylist()
            control, codes = [], []
            for a, b in _groups(counts):
                x, y = pack(rank_of[np.frombuffer(b"".join(raw[a:b]), id_type)], counts[a:b])
                control += x
                codes += y
            ends = before + np.cumsum(counts, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("shard"), pa.array(ends - counts, pa.int64()), batch.column("n"),
                 pa.array(control, pa.binary()), pa.array(codes, pa.binary())],
                names=["doc_id", "shard", "shard_start", "n_tokens", "control", "codes"])
            before = int(ends[-1]) if len(ends) else before

    return run


def _decode(id_of):
    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            counts, control, codes = (batch.column(c).to_pylist() for c in ("n_tokens", "control", "codes"))
            sums = []
            for a, b in _groups(counts):
                ids = memoryview(id_of[unpack(control[a:b], codes[a:b], counts[a:b])].astype("<u4").tobytes())
                ends = np.cumsum(counts[a:b]).tolist()
                sums += [zlib.crc32(ids[4 * (e - n) : 4 * e]) for e, n in zip(ends, counts[a:b])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("shard"), batch.column("shard_start"), batch.column("n_tokens"),
                 pa.array(sums, pa.int64())], names=["doc_id", "shard", "shard_start", "n_tokens", "ids_crc32"])

    return run


def write_ids(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> str:
    """Encode every text, write the two tables of the file format to a new shared folder and return its path."""
    import numpy as np

    spark = docs.sparkSession
    size = max(load_tokenizer(tokenizer).get_vocab_size(with_added_tokens=True), end_id + 1)
    id_type = "<u2" if size <= 1 << 16 else "<u4"
    key = T.StructField("doc_id", docs.schema["doc_id"].dataType)
    rows = cut_lineage(docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"), "text").mapInArrow(
        _tokenise(tokenizer, end_id, size, id_type),
        T.StructType([key, T.StructField("tie", T.LongType()), T.StructField("n", T.LongType()),
                      T.StructField("ids", T.BinaryType()),
                      T.StructField("seen", T.ArrayType(T.StructType([T.StructField("id", T.LongType()),
                                                                      T.StructField("n", T.LongType())])))])), "zstd")
    ids = rows.where(F.col("n").isNotNull()).drop("seen")
    seen = rows.where(F.col("n").isNull()).select(F.inline("seen")).groupBy("id").agg(F.sum("n").alias("n"))
    often = np.zeros(size, np.int64)
    for row in seen.collect():  # at most one row for each id of the vocabulary
        often[row["id"]] = row["n"]
    id_of = np.lexsort((np.arange(size), -often)).astype(np.uint32)
    rank_of = np.empty(size, np.uint32)
    rank_of[id_of] = np.arange(size, dtype=np.uint32)
    shards = int(min(MAX_SHARDS, 1 + often.sum() // TOKENS_PER_SHARD))
    dealt = (ids.repartitionByRange(shards, "doc_id", "tie").withColumn("shard", F.spark_partition_id())
             .sortWithinPartitions("doc_id", "tie"))
    schema = T.StructType([key, T.StructField("shard", T.IntegerType()), T.StructField("shard_start", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("control", T.BinaryType()),
                           T.StructField("codes", T.BinaryType())])
    path = shared_path(spark, "token-ids")
    dealt.mapInArrow(_encode(rank_of, id_type), schema).write.option("compression", "zstd").parquet(f"{path}/documents")
    spark.createDataFrame(list(enumerate(id_of.tolist())), "rank int, id int").coalesce(1).write.parquet(f"{path}/ranks")
    return path


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document of a file that ``write_ids`` wrote."""
    import numpy as np

    ranks = spark.read.parquet(f"{path}/ranks").collect()  # one row for each id of the vocabulary
    id_of = np.zeros(len(ranks), np.uint32)
    for row in ranks:
        id_of[row["rank"]] = row["id"]
    rows = spark.read.parquet(f"{path}/documents")
    totals = rows.groupBy("shard").agg(F.sum("n_tokens").alias("n"))  # at most MAX_SHARDS rows
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    schema = T.StructType([rows.schema["doc_id"], rows.schema["shard"], rows.schema["shard_start"], rows.schema["n_tokens"],
                           T.StructField("ids_crc32", T.LongType())])
    return (rows.mapInArrow(_decode(id_of), schema).join(F.broadcast(totals), "shard")
            .select("doc_id", (F.col("before") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32"))


def op2_token_ids(spark, sf_dir: str) -> DataFrame:
    """Ids of every document, written in the file format and read back."""
    return read_ids(spark, write_ids(table(spark, sf_dir, "documents")))
