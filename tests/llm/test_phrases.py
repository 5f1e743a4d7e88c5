import collections
import random
import re

from martwright.llm import phrases


def plain(rows, least=10, inside=50, best=2000):
    f = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        for piece in re.split("[.,;:!?\\n\\x0b\\x0c\\r]", (text or "").translate(table)):
            words = re.findall("[^ \\t]+", piece)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    f["und" if lang is None else lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        n = sum(c for p, c in counts.items() if len(p) == 1)
        chosen = {p: c for p, c in counts.items() if len(p) > 1 and c >= least}
        kept = []
        for p, a in chosen.items():
            longer = [c for q, c in chosen.items() if len(q) > len(p) and p in (q[:2], q[1:])]
            if any(100 * c >= inside * a for c in longer):
                continue
            cuts = [(10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, le, r) in enumerate(sorted(kept)[:best], 1):
            out.append((lang, rank, p.decode(), -a, le, r, n, -score))
    return sorted(out)


def corpus():
    rnd = random.Random(5)
    vocabulary = ["the", "of", "New", "york", "city", "caf\u00e9", "e\u0301t\u00e9", "a", "b", "-", "x\u00a0y"]
    rows = []
    for _ in range(400):
        text = "".join(rnd.choice(vocabulary) + rnd.choice([" ", " ", "  ", "\t", ", ", "\n", ".", "!"]) for _ in range(rnd.randint(0, 60)))
        rows.append((rnd.choice(["en", "en", "fr", None, ""]), text))
    rows += [("en", "new york city " * 300), ("en", None), ("fr", ""), ("de", "one two three"), (None, "tick tock " * 9)]
    return rows + [rows[0]] * 20


def test_against_brute_force(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, lang, i) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, n long")
    for every, best in ((1, 2000), (3, 5), (64, 2000)):
        monkeypatch.setattr(phrases, "EVERY", every)
        found = phrases.collocations(docs.repartition(3), best=best)
        assert sorted(map(tuple, found.collect())) == plain(rows, best=best)


def test_each_occurrence_is_in_one_chunk():
    triggers = phrases.Triggers()
    words = [f"w{i % 37}".encode() for i in range(500)]
    for every in (1, 2, 5, 64):
        triggers.clear()
        phrases.EVERY, old = every, phrases.EVERY
        try:
            found = list(phrases.chunks(words, triggers))
        finally:
            phrases.EVERY = old
        grams = [tuple(c.split()[i : i + 3]) for c, own in found for i in range(own)]
        assert grams == [tuple(words[i : i + 3]) for i in range(500)]


def test_nothing_to_count(spark, odd_docs, no_docs):
    assert phrases.collocations(no_docs).count() == 0
    rare = spark.createDataFrame([("en", "all of these words are rare")], "lang string, text string")
    assert phrases.collocations(rare).count() == 0
    rows = [(r.lang, r.text) for r in odd_docs.collect()]
    assert sorted(map(tuple, phrases.collocations(odd_docs).collect())) == plain(rows)
