"""Token counts of whole texts; huge texts are encoded in overlapping chunks and spliced.

The vocabulary is that of ``byte_bpe_50k.json``; its rank file ``byte_bpe_50k.tiktoken`` gives the
same ids several times faster (the tests hold the two libraries against each other), and the special
string is one token, as the .json file has it.

A text of more than ``chunk`` characters is encoded piece by piece. Each piece starts ``overlap``
characters before the end of the one before, and both encodings carry offsets. They are spliced at a
position in the overlap where both have a token boundary and where the pattern is proven to start a
new word whatever surrounds it: at the first white space after a visible character, at the last blank
of a run before one, at a visible character after a line break, tab or any white space but the blank,
between letters and digits, or after a visible character that is neither (nor an apostrophe) before a
letter or digit; never inside or next to a special string. If an overlap holds no such position it is
widened, at last to the whole rest of the chunk before. If that holds none either, the two chunks are
encoded as one and the next is as long as both, so that a text without any splice is encoded a
bounded number of times.

Defined results: null texts are empty and have no tokens; a null key stays null; repeated rows get
equal counts; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANKS = "byte_bpe_50k.tiktoken"
END = "<|endoftext|>"
END_ID = 50256
CHUNK = 65536
OVERLAP = 512


@functools.cache
def encoding(ranks: str = RANKS):
    """The tokenizer and the byte length of every id, loaded once per Python worker."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(ranks), "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    tokenizer = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={END: END_ID}
    )
    lengths = np.zeros(END_ID + 1, np.int64)
    for word, i in table.items():
        lengths[i] = len(word)
    lengths[END_ID] = len(END)
    return tokenizer, lengths


def encode(text: str, ranks: str = RANKS) -> np.ndarray:
    return encoding(ranks)[0].encode_to_numpy(text, allowed_special="all")


# Unicode's white space.
BLANKS = frozenset(
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _kind(c: str) -> str:
    if c in BLANKS:
        return "s"
    if c.isspace():
        # Separators that some libraries take for white space and others do not.
        return "?"
    major = unicodedata.category(c)[0]
    return major if major in "LN" else "'" if c == "'" else "o"


def proven(text: str, p: int) -> bool:
    """Whether a word of the pattern starts at ``text[p]`` whatever precedes and follows."""
    if not 0 < p < len(text):
        return False
    near = text[max(0, p - len(END)) : p + len(END)]
    if END in near:
        return False
    left, right = _kind(text[p - 1]), _kind(text[p])
    if "?" in (left, right):
        return False
    if right == "s" and left != "s":
        return True
    if text[p] == " ":
        return p + 1 < len(text) and _kind(text[p + 1]) not in ("s", "?")
    if left == "s":
        return right != "s" and text[p - 1] != " "
    return (left, right) in {("L", "N"), ("N", "L"), ("o", "L"), ("o", "N")}


def _bounds(ids: np.ndarray, start: int, ranks: str) -> np.ndarray:
    """Byte offsets of the token ends of a piece that starts at byte ``start``."""
    return start + np.cumsum(encoding(ranks)[1][ids])


def encode_long(text: str, chunk: int = CHUNK, overlap: int = OVERLAP, ranks: str = RANKS) -> np.ndarray:
    """The ids of the whole text, from overlapping chunks."""
    if len(text) <= chunk:
        return encode(text, ranks)
    done: list[np.ndarray] = []
    begin, end, step = 0, chunk, chunk
    ids = encode(text[begin:end], ranks)  # begin is always a proven start
    while end < len(text):
        following = min(len(text), end + step)
        reach, cut = overlap, None
        while cut is None and reach < 2 * (end - begin):
            # A special string that the chunk's end may have cut does not reach the splice.
            back = max(begin, end - reach)
            new = encode(text[back:following], ranks)
            at = len(text[begin:back].encode())
            old_ends, new_ends = _bounds(ids, 0, ranks), _bounds(new, at, ranks)
            common = set(old_ends.tolist()) & set(new_ends[:-1].tolist())
            offset = at
            for p in range(back, end - len(END)):
                if p > back and offset in common and proven(text, p):
                    cut = p, offset
                    break
                offset += len(text[p].encode())
            reach *= 4
        if cut is None:
            end = following
            step = end - begin
            ids = encode(text[begin:end], ranks)
            continue
        p, offset = cut
        done.append(ids[: int(np.searchsorted(old_ends, offset)) + 1])
        ids = new[int(np.searchsorted(new_ends, offset)) + 1 :]
        begin, end, step = p, following, chunk
    return np.concatenate([*done, ids])


def counts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = 1024,
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """Rows (key, n_bytes, n_tokens, over_limit) of every text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [len(encode_long(x.as_py() or "", chunk, overlap)) for x in batch.column(1)]
            yield pa.record_batch(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64())], ["key", "n_bytes", "n_tokens"]
            )

    kind = docs.schema[key].dataType.simpleString()
    n_bytes = F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long")
    counted = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), n_bytes.alias("n_bytes")).mapInArrow(
        count, f"key {kind}, n_bytes long, n_tokens long"
    )
    return counted.select(
        F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
