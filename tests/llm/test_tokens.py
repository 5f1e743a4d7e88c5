import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from martwright.llm import tokens


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


ODD = ["<|endoftext|>", "  ", "\n\n ", "'s", "don't", "a" * 120, "日本語。テキスト", "😀", " ", "12a'll", " ", "<|endof"]


@pytest.mark.parametrize("chunk,overlap", [(200, 20), (64, 16), (500, 50)])
def test_spliced_chunks_equal_the_library(texts, library, chunk, overlap):
    rnd = random.Random(chunk)
    for _ in range(60):
        text = rnd.choice(texts)[: rnd.randint(50, 3000)]
        for _ in range(rnd.randint(0, 8)):
            at = rnd.randrange(len(text) + 1)
            text = text[:at] + rnd.choice(ODD) + text[at:]
        want = library.encode(text, add_special_tokens=False).ids
        assert tokens.encode(text).tolist() == want
        assert tokens.encode_long(text, chunk, overlap).tolist() == want


@pytest.mark.parametrize("text", ["a" * 3000, " " * 3000, "日本" * 800, "<|endoftext|>" * 100, "", "x"])
def test_overlaps_widen_where_nothing_is_stable(library, text):
    assert tokens.encode_long(text, 200, 20).tolist() == library.encode(text, add_special_tokens=False).ids


BLANK = [" ", "  ", "\n", "\t", "\r\n", " \n", "\n ", "\xa0", "\u3000", " \xa0", "\x1c", "\x85 ", "\u2028"]
VISIBLE = ["a", "word", "7", "12", "'", "'s", "--", "#", "\u00e9", "\u65e5\u672c", "\u3002", "e\u0301", "\U0001f600", "\u200b", "x_y", "<|endoftext|>", "<|"]


def test_proven_places_start_words_whatever_surrounds_them():
    import public_tokenizers
    import regex

    word = regex.compile(public_tokenizers.PATTERN)
    rnd = random.Random(8)
    seen = 0
    for _ in range(4000):
        text = "".join(rnd.choice(rnd.choice([BLANK, VISIBLE])) for _ in range(rnd.randint(2, 14)))
        # The pattern never meets a special string: those are cut out before it.
        places = [p for p in range(len(text)) if "<|endoftext|>" not in text and tokens.proven(text, p)]
        for p in places:
            # Texts that begin anywhere before the place and end anywhere after the character that proves it.
            for low, high in ((0, len(text)), (p - 1, len(text)), (rnd.randrange(p), rnd.randint(min(p + 2, len(text)), len(text)))):
                starts = {low + m.start() for m in word.finditer(text[low:high])}
                assert p in starts, (text, p, low, high)
                seen += 1
    assert seen > 10000


@pytest.mark.parametrize("chunk,overlap", [(64, 16), (300, 20)])
def test_chunks_of_texts_without_single_blanks(library, chunk, overlap):
    rnd = random.Random(chunk)
    for _ in range(150):
        gap = rnd.choice(BLANK)
        text = "".join(rnd.choice(VISIBLE) + rnd.choice([gap, gap, gap, "", rnd.choice(BLANK)]) for _ in range(rnd.randint(50, 600)))
        want = library.encode(text, add_special_tokens=False).ids
        assert tokens.encode_long(text, chunk, overlap).tolist() == want


@pytest.mark.parametrize("unit", ["word\n", "word\t", "word  ", "-", "a", "\n", "- - ", "<|endoftext|>"])
def test_work_grows_with_the_text(monkeypatch, unit):
    encoded = []
    plain = tokens.encode
    monkeypatch.setattr(tokens, "encode", lambda text, ranks=tokens.RANKS: encoded.append(len(text)) or plain(text, ranks))
    text = unit * (200000 // len(unit))
    tokens.encode_long(text, 2000, 50)
    assert sum(encoded) < 30 * len(text)


def test_counts_of_odd_documents(odd_docs, no_docs, library):
    want = sorted(
        (str(r.doc_id), len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids))
        for r in odd_docs.collect()
    )
    found = tokens.counts(odd_docs, chunk=5000).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in found) == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in found)
    assert tokens.counts(no_docs).count() == 0
