"""Importance resampling, substring dedup and phrase mining against brute force and hand-made cases."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from ratingmill.llm import hot_keys, importance, phrases, quotient_filter, substring_dedup

DOC = "doc_id bigint, text string, lang string, source string, seed bigint, whole bigint, n int, rank int, phrase string, bucket int, word string"
EXTRA = ("s", 1, 2, 3, 4, "p", 5, "w")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, *EXTRA) for i, t, lang in rows], DOC)


def awkward():
    rng = random.Random(5)
    words = ["alpha", "Beta", "ümlaut", "中文", "x" * 50, "\x1f", "a.b", "..."]
    long = " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(20_000))
    some = " ".join(rng.choice(words) + str(rng.randrange(400)) for _ in range(120))
    return [
        (1, None, "en"), (2, "", None), (3, " \n\t ", "en"), (4, "one", "de"), (5, "ONE two", None), (7, long, "en"), (8, long + " end", "en"),
        (9, some, "en"), (9, some, "en"), (10, some.replace(" ", "\n"), "de"), (11, some + "\x0b", None), (12, "a" * 5000, "en"), (None, some, "en"),
        (None, some + " tail", "und"), (13, "start " + some + " " + some, "en"),
    ]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# --- importance resampling -------------------------------------------------------------------


def grams(text):
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    return len(ws), [" ".join(ws[i : i + n]) for n in (1, 2, 3) for i in range(len(ws) - n + 1)]


def resampled_by_brute_force(rows, target, share=(5, 100)):
    def bucket(g):
        return zlib.crc32(g.encode()) % 10_000

    s = collections.Counter(bucket(g) for _, t, _ in rows for g in grams(t)[1])
    t = collections.Counter(bucket(g) for x in target for g in grams(x)[1])
    top, low = sum(s.values()) + 10_000, sum(t.values()) + 10_000

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * top / ((s[b] + 1) * low)))

    out = []
    for i, text, _ in rows:
        n, found = grams(text)
        weight = sum(gain(bucket(g)) for g in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, n, len(found), weight, score))
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = able[: len(able) * share[0] // share[1]]
    return out, drawn


def test_resampling_equals_brute_force(spark):
    rows, target = awkward(), ["alpha1 beta2 end", None, "中文3 ümlaut4"]
    goal = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id bigint, text string")
    got = importance.resample(frame(spark, rows), goal, share=(50, 100)).collect()
    want, drawn = resampled_by_brute_force(rows, target, (50, 100))
    assert sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_features", "weight", "score")) for r in got), key=repr) == sorted(want, key=repr)
    placed = sorted((r["rank"], r["score"]) for r in got if r["rank"] is not None)
    assert placed == [(k + 1, r[4]) for k, r in enumerate(drawn)]


def test_slices_carry_words():
    text = ("Eins zwei, drei! vier " * 50).encode()
    whole = [h for _, hs in importance.feature_hashes(importance.word_slices(text)) for h in hs]
    cut = [h for _, hs in importance.feature_hashes(importance.word_slices(text, 7)) for h in hs]
    assert sorted(whole) == sorted(cut) == sorted(zlib.crc32(g.encode()) for g in grams(text.decode())[1])


def test_resampling_of_empty_tables(spark):
    none = frame(spark, [])
    goal = spark.createDataFrame([], "item_id bigint, text string")
    assert importance.resample(none, goal).collect() == []
    rows = importance.resample(frame(spark, awkward()), goal).collect()
    assert len(rows) == len(awkward())


# --- substring dedup -------------------------------------------------------------------------


def cut_by_brute_force(rows, window):
    first = {}
    split = [(2**63 if i is None else i, (t or "").encode().split()) for i, t, _ in rows]
    for i, ws in split:
        for k in range(len(ws) - window + 1):
            key = b" ".join(ws[k : k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for (i, ws), (own, _, _) in zip(split, rows):
        gone = np.zeros(len(ws), bool)
        for k in range(len(ws) - window + 1):
            if first[b" ".join(ws[k : k + window])] < i:
                gone[k : k + window] = True
        out.append((own, len(ws), int(gone.sum()), b" ".join(w for w, g in zip(ws, gone) if not g).decode()))
    return sorted(out, key=repr)


def cut(spark, rows, window):
    got = substring_dedup.remove_repeats(frame(spark, rows), window).collect()
    for r in got:
        assert sum(x["end"] - x["first"] for x in r["repeats"]) == r["n_removed"]
        assert all(x["end"] - x["first"] >= window for x in r["repeats"])
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=repr)


def test_substring_dedup_of_awkward_rows(spark):
    assert cut(spark, awkward(), 50) == cut_by_brute_force(awkward(), 50)
    assert cut(spark, [], 50) == []


@pytest.mark.parametrize("window", [2, 3, 8, 11])
def test_substring_dedup_of_few_words(spark, window):
    """A small alphabet gives seeds with many different extensions, overlaps, self-overlaps and ties."""
    rng = random.Random(window)
    rows = [(rng.choice([None, *range(60)]), " ".join(rng.choice("abc") for _ in range(rng.randrange(60))), "en") for _ in range(150)]
    assert cut(spark, rows, window) == cut_by_brute_force(rows, window)


def test_substring_dedup_with_hot_seeds(spark, monkeypatch):
    """One passage with different words around it in all documents; hot keys are joined where they lie."""
    monkeypatch.setattr(hot_keys, "HOT_ROWS", 5)
    monkeypatch.setattr(hot_keys, "HOT_KEYS", 50)
    rng = random.Random(1)
    passage = " ".join(f"p{i}" for i in range(9))
    rows = [(i, f"{rng.randrange(9)} {rng.randrange(3)} {passage} {rng.randrange(3)} {rng.randrange(9)}", "en") for i in range(200)]
    assert cut(spark, rows, 10) == cut_by_brute_force(rows, 10)


# --- phrases ---------------------------------------------------------------------------------


def mined_by_brute_force(rows, least, longest, top):
    f, n = collections.Counter(), collections.Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, longest + 1):
                for i in range(len(ws) - k + 1):
                    f[lang, tuple(ws[i : i + k])] += 1
    found = collections.defaultdict(list)
    often = {x: c for x, c in f.items() if len(x[1]) > 1 and c >= least}
    gone = {
        (lang, ws[i:j])
        for (lang, ws), c in often.items() for i in range(len(ws)) for j in range(i + 2, len(ws) + 1)
        if j - i < len(ws) and c >= f[lang, ws[i:j]]
    }
    for (lang, ws), a in often.items():
        if (lang, ws) not in gone:
            cuts = [(1000 * a * n[lang] // (f[lang, ws[:k]] * f[lang, ws[k:]]), k) for k in range(1, len(ws))]
            score, k = min(cuts)
            found[lang].append((-score, -a, " ".join(ws).encode(), f[lang, ws[:k]], f[lang, ws[k:]]))
    return sorted(
        (lang, rank + 1, p.decode(), -a, left, right, n[lang], -score)
        for lang, rows in found.items() for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top])
    )


def mined(spark, rows, least, longest=5, top=2000, **sizes):
    got = phrases.collocations(frame(spark, rows), least, longest, top, **sizes).collect()
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in got)


def test_phrases_equal_brute_force(spark):
    rng = random.Random(2)
    words = ["Red", "red", "ümlaut", "中", "\x1f", "a-b", "x", "y"]
    marks = [" ", " ", " ", "\t", ". ", ",", "\n", "  "]
    rows = [
        (i, "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randrange(80))), rng.choice(["en", "de", None, "und"]))
        for i in range(120)
    ]
    rows += awkward()
    assert mined(spark, rows, 4, chunk_bytes=600, shard_entries=300) == mined_by_brute_force(rows, 4, 5, 2000)
    assert mined(spark, rows, 6, longest=3, top=7) == mined_by_brute_force(rows, 6, 3, 7)


def test_phrases_of_few_rows(spark):
    assert mined(spark, [], 1) == []
    assert mined(spark, [(1, None, None), (2, "a", "en")], 1) == []
    assert mined(spark, [(1, "a b", None)], 1) == [("und", 1, "a b", 1, 1, 1, 2, 2000)]


def test_quotient_filters_are_lossless():
    rng = np.random.default_rng(3)
    for bits in (1, 7, 20, 33, 63, 64):
        permuted = quotient_filter.Permutation(bits)
        keys = rng.integers(0, 1 << bits, 3000, dtype=np.uint64)
        assert (permuted.inverse(permuted(keys)) == keys).all()
        if bits == 7:
            assert len(np.unique(permuted(np.arange(128, dtype=np.uint64)))) == 128
        held, counts = quotient_filter.counted(np.sort(permuted(keys)))
        counts = counts * 200
        back, again = quotient_filter.decode(quotient_filter.encode(held, counts, bits), bits)
        assert (back == held).all() and (again == counts).all()
        half = len(held) // 2
        merged, sums = quotient_filter.merge([(held, counts), (held[half:], counts[half:])])
        assert (merged == held).all() and sums.sum() == counts.sum() + counts[half:].sum()


def test_scores_pass_64_bits(spark):
    a = spark.createDataFrame([(9_999_999_999_999, 99_999_999_999_999, 12_345_678_901_234, 9_876_543_210_987)], "a long, n long, l long, r long")
    got = a.select(phrases._ratio(a.a, a.n, a.l, a.r)).first()[0]
    assert got == 1000 * 9_999_999_999_999 * 99_999_999_999_999 // (12_345_678_901_234 * 9_876_543_210_987)
