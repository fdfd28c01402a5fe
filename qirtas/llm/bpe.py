"""Byte-pair encoding and decoding through a table of distinct words.

1. Texts are split into words; words are counted, partly before the shuffle.
2. Each distinct word is encoded once: those met more than once into a written
   table word -> ids, the others where they stand.  A bitmap of fixed size tells
   a task which words may be in the table.
3. The ids come back by position.  The most frequent words, a bounded number,
   are broadcast, so their occurrences never move.  The others are joined word by
   word and meet their document, whose frequent words stand there as ranks and
   whose own words as ids.
4. Decoding looks each id up in the id-to-piece table of the vocabulary.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qirtas.llm import common
from qirtas.llm.ngram_join import bitmap, marked
from qirtas.llm.words import WordIds, encode_words, split_words, tokenizer
from qirtas.storage import materialize

# At most so many words of at most so many bytes are broadcast: 20 MB, 60 MB at the worst.
HOT_WORDS = 600_000
HOT_BYTES = 64
# Numbers of occurrences are told apart up to this one when the frequent words are chosen.
COUNTED = 4_096
# Bits that mark the hashes of the table's words: 4 MB, whatever the data.
WORD_BITS = 25
# What stands for a word that is not broadcast: its ids come from the table, or stand beside.
FROM_TABLE, BESIDE, FIRST_RANK = 0, 1, 2
# About so many bytes of coded texts, a word has at least one, become ids at a time.
FILL_BYTES = 1 << 20
# A counting task hands on what it has when it has met so many distinct words.
FLUSH_WORDS = 200_000


def text_key(text: str) -> Column:
    """Tells apart rows that share a document id."""
    return F.xxhash64(text)


def count_words(df: DataFrame, path: str, text: str) -> DataFrame:
    marks = WordIds(path).marks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            words = pa.array(list(counts), pa.binary()).cast(pa.string())
            out = pa.RecordBatch.from_arrays(
                [words, pa.array(list(counts.values()), pa.int64())], ["word", "n"]
            )
            counts.clear()
            return out

        for (texts,) in common.slices(batches):
            for t in texts:
                counts.update(split_words(t, marks))
            if len(counts) > FLUSH_WORDS:
                yield flush()
        yield flush()

    partial = common.map_batches(df.select(text), run, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def word_table(df: DataFrame, path: str, text: str = "text", least: int = 1) -> DataFrame:
    """Written table: each distinct word met ``least`` times, its occurrences, its ids as packed numbers."""

    def work(columns: list[list]) -> list[list]:
        words, n = columns
        return [words, n, [pack_ids(blob) for blob in encode_words(path, [w.encode() for w in words])]]

    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("ids", pa.binary())])
    counted = count_words(df, path, text).filter(F.col("n") >= least)
    return materialize(common.map_rows(counted, work, "word string, n long, ids binary", schema), "words")


def frequent(table: DataFrame, limit: int) -> list[tuple[str, bytes]]:
    """The most frequent short words, at most ``limit``, most frequent first.

    All words that occur equally often are in or out together.
    """
    short = table.filter(F.octet_length("word") <= HOT_BYTES)
    often = F.least("n", F.lit(COUNTED))
    sizes = {r[0]: r[1] for r in short.groupBy(often).count().collect()}
    cut, size = COUNTED + 1, 0
    for n in sorted(sizes, reverse=True):
        size += sizes[n]
        if size > limit:
            break
        cut = n
    rows = short.filter(often >= cut).select("n", "word", "ids").toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    return list(zip(rows["word"].to_pylist(), map(unpack_ids, rows["ids"].to_pylist()), strict=True))


def pack_lists(values: np.ndarray, begin: np.ndarray | list[int]) -> list[bytes]:
    """Each ``values[begin[k] : begin[k + 1]]``: seven bits a byte, the lowest first; the top bit says that more follow."""
    size = 1 + (values >= 1 << 7) + (values >= 1 << 14) + (values >= 1 << 21)
    ends = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(int(ends[-1]), np.uint8)
    for k in range(4):
        has = np.flatnonzero(size > k)
        more = (size[has] > k + 1) << 7
        out[ends[has] + k] = (values[has] >> 7 * k & 127) | more
    raw, cut = out.tobytes(), ends[begin].tolist()
    return [raw[i:j] for i, j in zip(cut, cut[1:], strict=False)]


def unpack_lists(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all lists, and where each list begins (and the last one ends)."""
    raw = np.frombuffer(b"".join(blobs), np.uint8)
    last = np.flatnonzero(raw < 128)
    first = np.zeros(len(last), np.int64)
    first[1:] = last[:-1] + 1
    values = (raw[first] & 127).astype(np.int64)
    for k in range(1, 4):
        has = np.flatnonzero(last - first >= k)
        values[has] |= (raw[first[has] + k] & 127).astype(np.int64) << 7 * k
    return values, np.searchsorted(last, np.cumsum([0, *map(len, blobs)]))


def pack_numbers(values: np.ndarray) -> bytes:
    return pack_lists(values, [0, len(values)])[0]


def unpack_numbers(blob: bytes) -> np.ndarray:
    return unpack_lists([blob])[0]


def pack_ids(blob: bytes) -> bytes:
    """What ``pack_numbers`` says, for the few ids of a word."""
    out = bytearray()
    for value in memoryview(blob).cast("I"):
        while value > 127:
            out.append(value & 127 | 128)
            value >>= 7
        out.append(value)
    return bytes(out)


def unpack_ids(packed: bytes) -> bytes:
    ids, value, shift = [], 0, 0
    for byte in packed:
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            ids.append(value)
            value = shift = 0
    return struct.pack(f"<{len(ids)}I", *ids)


def pack_words(blobs: list[bytes], begin: list[int]) -> list[bytes]:
    """For each ``blobs[begin[k] : begin[k + 1]]`` its words' number, their sizes and their ids, as packed numbers."""
    sizes = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
    ids = np.frombuffer(b"".join(blobs), "<u4").astype(np.int64)
    at = np.concatenate([[0], np.cumsum(sizes)])
    lists = [np.concatenate([[j - i], sizes[i:j], ids[at[i] : at[j]]]) for i, j in zip(begin, begin[1:], strict=False)]
    return pack_lists(np.concatenate([np.zeros(0, np.int64), *lists]), np.cumsum([0, *map(len, lists)]))


def unpack_words(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The sizes of all words in all lists, and their ids."""
    numbers, begin = unpack_lists(packed)
    none = np.zeros(0, np.int64)
    sizes, ids = [none], [none]
    for i, j in zip(begin.tolist(), begin[1:].tolist(), strict=False):
        behind = i + 1 + int(numbers[i])
        sizes.append(numbers[i + 1 : behind])
        ids.append(numbers[behind:j])
    return np.concatenate(sizes), np.concatenate(ids)


def pack_blobs(blobs: list[bytes]) -> bytes:
    return pack_words(blobs, [0, len(blobs)])[0]


def unpack_blobs(packed: bytes) -> list[bytes]:
    sizes, ids = unpack_words([packed])
    raw, cut = ids.astype("<u4").tobytes(), np.cumsum([0, *sizes * 4]).tolist()
    return [raw[i:j] for i, j in zip(cut, cut[1:], strict=False)]


class Ids:
    """The ids of words one behind another, and where those of each word begin and how many they are."""

    def __init__(self, blobs: list[bytes]):
        self.ids = np.frombuffer(b"".join(blobs), "<u4")
        self.size = np.fromiter(map(len, blobs), np.int32, len(blobs)) // 4
        self.begin = np.cumsum(self.size) - self.size


def whole_ids(path: str, hot: Ids, coded: list[bytes], beside: list[bytes], rare: list[list[bytes] | None]) -> list[bytes]:
    """The ids of each text; ``hot`` has those of a code, what stands for no word has none there."""
    codes, begin = unpack_lists(coded)
    own_sizes, own_ids = unpack_words(beside)
    met = {}
    for row, found in enumerate(rare):
        for word in found or ():
            place, unmet = divmod(int.from_bytes(word[:4], "big"), 2)
            met[int(begin[row]) + place] = encode_words(path, [word[4:]])[0] if unmet else unpack_ids(word[4:])
    rest = Ids(list(met.values()))
    own, at = np.flatnonzero(codes == BESIDE), np.fromiter(met, np.int64, len(met))
    size, source = hot.size[codes].astype(np.int64), hot.begin[codes].astype(np.int64)
    size[own], source[own] = own_sizes, len(hot.ids) + np.cumsum(own_sizes) - own_sizes
    size[at], source[at] = rest.size, len(hot.ids) + len(own_ids) + rest.begin
    ends = np.concatenate([[0], np.cumsum(size)])
    place = np.arange(ends[-1]) + np.repeat(source - ends[:-1], size)
    raw = np.concatenate([hot.ids, own_ids.astype("<u4"), rest.ids])[place].tobytes()
    cut = (4 * ends[begin]).tolist()
    return [raw[i:j] for i, j in zip(cut, cut[1:], strict=False)]


def word_hashes(words: list[bytes]) -> np.ndarray:
    """Spark's ``xxhash64`` of the words."""
    return np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in words), np.uint64, len(words))


def classified(texts: list[str | None], marks: tuple[bytes, ...], rank: dict, cells: np.ndarray):
    """All words of the texts, what stands for each, and where each text begins."""
    split = [split_words(t, marks) for t in texts]
    words = list(chain.from_iterable(split))
    get = rank.get
    codes = np.fromiter(map(get, words, repeat(FROM_TABLE)), np.int64, len(words))
    at = np.flatnonzero(codes == FROM_TABLE)
    codes[at[~marked(cells, word_hashes([words[k] for k in at.tolist()]))]] = BESIDE
    return words, codes, np.cumsum([0, *map(len, split)])


@lru_cache(maxsize=2)
def id_to_piece(path: str) -> tuple[np.ndarray, object]:
    """The piece of each id, as many as the vocabulary has, and its joining rule if any."""
    t = tokenizer(path)
    return np.array([t.id_to_token(i) or "" for i in range(t.get_vocab_size())], object), t.decoder


def decode(path: str, ids: np.ndarray) -> str:
    pieces, rule = id_to_piece(path)
    found = pieces[ids].tolist()
    return " ".join(found) if rule is None else rule.decode(found)


def encode(
    df: DataFrame, path: str, key: str = "doc_id", text: str = "text", hot_words: int = HOT_WORDS
) -> DataFrame:
    """key and ids (binary, little-endian unsigned 32-bit) of each row's whole text.

    A null or empty text has no ids.  Rows that repeat a key are told apart by
    their texts; rows that repeat both are all encoded.  A null key is kept.
    ``hot_words`` chooses the way a word's ids come back, never what they are.
    """
    spark = df.sparkSession
    marks = WordIds(path).marks
    table = word_table(df, path, text, least=2)
    hot = frequent(table, hot_words)
    rank = spark.sparkContext.broadcast({w.encode(): k + FIRST_RANK for k, (w, _) in enumerate(hot)})
    hot_ids = spark.sparkContext.broadcast(Ids([b""] * FIRST_RANK + [ids for _, ids in hot]))
    cells = spark.sparkContext.broadcast(bitmap(table.select(F.xxhash64("word").alias("hash")), "hash", WORD_BITS))
    rows = df.select(F.col(key).alias("_key"), text_key(text).alias("_text"), text)
    declared, field = common.key_field(rows, "_key")

    def rare(columns: list[list]) -> list[list]:
        words, codes, begin = classified(columns[2], marks, rank.value, cells.value)
        at = np.flatnonzero(codes == FROM_TABLE)
        row = np.searchsorted(begin, at, "right") - 1
        place, row = (at - begin[row]).tolist(), row.tolist()
        return [[columns[0][r] for r in row], [columns[1][r] for r in row], place, [words[k].decode() for k in at.tolist()]]

    def ranks(columns: list[list]) -> list[list]:
        words, codes, begin = classified(columns[2], marks, rank.value, cells.value)
        at = np.flatnonzero(codes == BESIDE)
        found = encode_words(path, [words[k] for k in at.tolist()])
        cut = np.searchsorted(at, begin).tolist()
        coded = [zlib.compress(packed, 1) for packed in pack_lists(codes, begin)]
        return [columns[0], columns[1], coded, pack_words(found, cut)]

    occurrences = common.map_rows(
        rows, rare, f"{declared}, _text long, at int, word string",
        pa.schema([field, ("_text", pa.int64()), ("at", pa.int32()), ("word", pa.string())]),
    )
    # What comes back is twice the place in four bytes, then the packed ids.  A word met once may fall on a
    # marked bit: it comes back as it went, the place's last bit set, and is encoded then.
    head = F.col("at").cast("long") * 2 + F.col("ids").isNull().cast("long")
    met_at = F.concat(F.unhex(F.lpad(F.hex(head), 8, "0")), F.coalesce("ids", F.encode("word", "UTF-8")))
    returned = (
        occurrences.join(table.select("word", "ids").hint("shuffle_merge"), "word", "left")
        .groupBy(F.col("_key").alias("_rare_key"), F.col("_text").alias("_rare_text"))
        .agg(F.collect_set(met_at).alias("rare"))  # a set: repeated rows say the same
    )
    coded = common.map_rows(
        rows, ranks, f"{declared}, _text long, coded binary, beside binary",
        pa.schema([field, ("_text", pa.int64()), ("coded", pa.binary()), ("beside", pa.binary())]),
    )
    same = F.col("_key").eqNullSafe(F.col("_rare_key")) & (F.col("_text") == F.col("_rare_text"))
    met = coded.join(returned.hint("shuffle_merge"), same, "left").select("_key", "coded", "beside", "rare")

    def fill(columns: list[list]) -> list[list]:
        out, coded, size = [], [], 0
        for k, code in enumerate(columns[1], 1):
            coded.append(zlib.decompress(code))
            size += len(coded[-1])
            if size > FILL_BYTES or k == len(columns[1]):
                some = slice(len(out), k)
                out += whole_ids(path, hot_ids.value, coded, columns[2][some], columns[3][some])
                coded, size = [], 0
        return [columns[0], out]

    filled = common.map_rows(
        met, fill, f"{declared}, ids binary", pa.schema([field, ("ids", pa.binary())])
    )
    return filled.withColumnRenamed("_key", key)


def digests(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of encoded rows; decodes every row."""
    declared, field = common.key_field(encoded, key)

    def work(columns: list[list]) -> list[list]:
        out: list[list] = [columns[0], [], [], []]
        for blob in columns[1]:
            out[1].append(len(blob) // 4)
            out[2].append(hashlib.sha256(blob).hexdigest())
            text = decode(path, np.frombuffer(blob, "<u4"))
            out[3].append(hashlib.sha256(text.encode()).hexdigest())
        return out

    return common.map_rows(
        encoded.select(key, "ids"), work,
        f"{declared}, n_tokens long, ids_sha256 string, decoded_sha256 string",
        pa.schema([field, ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]),
    )


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return digests(encode(common.table(spark, sf_dir, "documents"), path), path)
