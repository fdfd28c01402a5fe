"""Token counts of whole texts; huge ones by overlapping chunks that resynchronise."""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from qirtas.llm import common
from qirtas.llm.words import tokenizer, word_ids

CHUNK = 16_384
OVERLAP = 512
LIMIT = 2_048
ASCII_SPACE = frozenset(" \t\n\r\x0b\x0c")


def starts(path: str, text: str, begin: int, end: int) -> list[tuple[int, int]]:
    """(start in the text, id) of each token of ``text[begin:end]``."""
    e = tokenizer(path).encode(text[begin:end], add_special_tokens=False)
    return [(begin + s, i) for (s, _), i in zip(e.offsets, e.ids, strict=True)]


def boundary(
    text: str, left: list[tuple[int, int]], right: list[tuple[int, int]], begin: int, end: int
) -> int | None:
    """A stable common boundary inside ``text[begin:end]``, or None.

    Proven stable: white space stands before it, which no token of either chunk
    can reach across; both chunks start a token there; and from there to the last
    white space before ``end``, where the left chunk is still whole, both have
    the same tokens at the same places.
    """
    last = end
    while last > begin and text[last - 1] not in ASCII_SPACE:
        last -= 1
    ours = [x for x in left if begin < x[0] < last]
    theirs = [x for x in right if begin < x[0] < last]
    common_starts = {s for s, _ in ours} & {s for s, _ in theirs}
    for p in sorted(common_starts):
        if text[p - 1] in ASCII_SPACE:
            same = [x for x in ours if x[0] >= p] == [x for x in theirs if x[0] >= p]
            return p if same else None
    return None


def spliced_ids(path: str, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """Ids of ``text`` from chunks of ``chunk`` characters.

    Where neighbours have no stable common boundary in their overlap, the
    overlap is doubled, at last up to the whole text behind the left chunk's
    beginning; so the result never depends on the sizes.
    """
    done: list[int] = []
    begin, end = 0, min(chunk, len(text))
    left = starts(path, text, begin, end)
    while end < len(text):
        wide = overlap
        while True:
            next_begin = max(end - wide, begin)
            next_end = min(max(next_begin + chunk, end + overlap), len(text))
            right = starts(path, text, next_begin, next_end)
            if next_begin == begin:  # it holds all of the left chunk: nothing to splice
                p = begin
                break
            p = boundary(text, left, right, next_begin, end)
            if p is not None:
                break
            wide *= 2
        done += [i for s, i in left if s < p]
        left = [x for x in right if x[0] >= p]
        begin, end = p, next_end
    return done + [i for _, i in left]


def count_tokens(
    df: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    limit: int = LIMIT,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """key, n_bytes, n_tokens, over_limit of each row; other columns are not carried.

    ``path`` names a vocabulary of the tokenizers library (.json) or of
    sentencepiece (.model, encoded whole).  A null or empty text has no bytes and
    no tokens; repeated rows and null keys are counted like any other.  No row
    moves between tasks.  Texts of at most ``chunk`` characters are put together
    from words that a worker has met before, longer ones from overlapping chunks.
    """

    def work(columns: list[list]) -> list[list]:
        keys, texts = columns[0], [t or "" for t in columns[1]]
        if path.endswith(".model"):
            counts = [len(ids) for ids in _pieces(path).encode(texts, num_threads=1)]
        else:
            small = [t if len(t) <= chunk else "" for t in texts]
            counts = [len(b) // 4 for b in word_ids(path).blobs(small)]
            for k, t in enumerate(texts):
                if len(t) > chunk:
                    counts[k] = len(spliced_ids(path, t, chunk, overlap))
        return [keys, [len(t.encode()) for t in texts], counts, [n > limit for n in counts]]

    column, field = common.key_field(df, key)
    return common.map_rows(
        df.select(key, text),
        work,
        f"{column}, n_bytes long, n_tokens long, over_limit boolean",
        pa.schema([field, ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())]),
    )


def _pieces(path: str):
    import sentencepiece

    if path not in _models:
        _models[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _models[path]


_models: dict = {}


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return count_tokens(common.table(spark, sf_dir, "documents"), path)
