"""The training-text operators against SQL, brute force and hand-made cases."""

import collections
import hashlib
import importlib
import json
import math
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingmill.llm import decontamination, exact_dedup, licenses, line_dedup, lm_mixing, mixing, near_dedup, suffix_dedup, tool_calls, toxicity
from ratingmill.llm.components import components
from ratingmill.llm.queries import QUERIES
from ratingmill.llm.suffix_sort import suffix_order
from ratingmill.plans.check import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, label string, n int, rep int"
# Names of extra columns that the operators use inside.
EXTRA = ("x", "y", 1, 2)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name].run(spark, FOLDER)
    cursor = duck.execute(QUERIES[name].sql)
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cursor.fetchall())


def frame(spark, rows, source="s"):
    return spark.createDataFrame([(i, t, "en", source, len(t or ""), *EXTRA) for i, t in rows], DOC)


def given(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]


def awkward():
    """Null, empty and blank texts, a long one, repeated rows, ties and odd characters."""
    rng = random.Random(3)
    words = ["alpha", "Beta", "ümlaut", "中文", "x" * 50, "\x1f", "a b", "..."]
    long = " ".join(rng.choice(words) + str(rng.randrange(400)) for _ in range(20_000))
    some = " ".join(rng.choice(words) + str(rng.randrange(400)) for _ in range(120))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "ONE"), (6, "one two three four"), (7, long), (8, long + " end"),
        (9, some), (9, some), (10, some.replace(" ", "\n")), (11, some + "\x0b"), (12, "a" * 5000), (None, some), (13, "line one here\nline one here\n\nother"),
    ]


def fold(text):
    return (text or "").encode().lower().split()


def components_by_brute_force(rows, link):
    sets, parent = {}, {}
    for i, t in rows:
        w = fold(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
        parent[i] = i

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= link * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {(i, len(s), root(i), root(i) == i) for i, s in sets.items()}


def repeats_by_brute_force(rows, match):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(t[s : s + match] for _, t in texts for s in range(len(t) - match + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for s in range(len(t) - match + 1):
            if seen[t[s : s + match]] > 1:
                gone[s : s + match] = b"\1" * match
        runs = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(t), sum(gone), runs, bytes(b for b, x in zip(t, gone) if not x)))
    return sorted(out, key=repr)


# --- exact dedup ---------------------------------------------------------------------------


def test_cuckoo_index_inserts_deletes_and_grows():
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(6000)]
    index = exact_dedup.CuckooIndex(8)
    for i, k in enumerate(keys):
        assert index.insert(k, i)
    assert not index.insert(keys[5], 2, 3) and index.sizes[index.find(keys[5])] == 4 and index.kept[index.find(keys[5])] == 2
    assert all(index.find(k) >= 0 for k in keys)
    for k in keys[::2]:
        assert index.delete(k)
    assert not index.delete(keys[0]) and len(index) == 3000
    assert all((index.find(k) >= 0) == bool(i % 2) for i, k in enumerate(keys))
    # A fingerprint that matches is no hit: same first ten bytes, other digest.
    assert index.find(keys[1][:10] + bytes(22)) == -1


def test_index_changes(spark):
    docs = exact_dedup.digests(frame(spark, [(1, "a b"), (2, "a  b"), (3, "c")])).select("doc_id", F.unhex("text_sha256").alias("digest"))
    index = exact_dedup.build_index(docs, 4)
    sha = {t: hashlib.sha256(t.encode()).digest() for t in ("a b", "c", "d")}
    changes = spark.createDataFrame([("delete", None, sha["a b"]), ("delete", None, sha["d"]), ("insert", 9, sha["d"]), ("insert", 8, sha["c"])], "op string, doc_id bigint, digest binary")
    got = {(bytes(r["digest"]), r["keep_id"], r["group_size"]) for r in exact_dedup.apply_changes(index, changes, 4).collect()}
    assert got == {(sha["c"], 3, 2), (sha["d"], 9, 1)}


def test_exact_dedup_of_awkward_rows(spark):
    rows = awkward()
    got = exact_dedup.exact_dedup(frame(spark, rows)).collect()
    norm = lambda t: __import__("re").sub("[\x20\x09-\x0d]+", " ", t or "")
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    want = []
    for i, t in rows:
        own = [x for x in groups[norm(t)] if x is not None]
        want.append((i, min(own), len(groups[norm(t)]), i == min(own), hashlib.sha256(norm(t).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert exact_dedup.exact_dedup(frame(spark, [])).count() == 0


# --- language model ------------------------------------------------------------------------


def test_language_model_counts_and_scores(spark):
    rows = given(spark) + [(10_001, None), (10_002, "  ")]
    got = lm_mixing.score(frame(spark, rows)).collect()
    seen = collections.Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            seen.update([*fold(t), None])
    total, size = sum(seen.values()), len(seen)
    text = dict(rows)
    for r in got:
        tokens = [*fold(text[r["doc_id"]]), None]
        base = sum(math.log10((seen[w] + 0.5) / (total + 0.5 * (size + 1))) for w in tokens)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(seen[w] > 0 for w in tokens), total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and r["score"] < 0
    learnt = [r for r in got if not r["held_out"]]
    assert sum(r["score"] for r in learnt) > sum(r["base_score"] for r in learnt)


def test_code_tree_is_a_prefix_code():
    begin, nodes, bits = lm_mixing.code_tree([5] * 10 + [0] * 246)
    codes = {"".join(map(str, bits[a:b])) for a, b in zip(begin, begin[1:])}
    assert len(codes) == 256 and abs(sum(2.0 ** -len(c) for c in codes) - 1) < 1e-9


def test_bits_are_a_probability():
    """The probabilities of all continuations of a text by one byte add up to one."""
    tree = lm_mixing.code_trees(np.ones((256, 256), int))
    rng = np.random.default_rng(1)
    odds = [rng.normal(0, 1, 1 << b).astype(np.float16) for b in lm_mixing.SLOT_BITS]
    mixer = lm_mixing.Mixer(tree, odds, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    start = np.frombuffer(b"some text that goes on ", np.uint8)
    texts = [np.append(start, b).astype(np.uint8) for b in range(256)]
    begin = np.arange(257) * (len(start) + 1)
    whole = mixer.costs(np.concatenate(texts), begin)
    head = mixer.costs(start, np.array([0, len(start)]))[0]
    assert abs(sum(2.0 ** -(whole - head)) - 1) < 1e-3


def test_language_model_of_empty_tables(spark):
    assert lm_mixing.score(frame(spark, [])).count() == 0
    held = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1)
    r = lm_mixing.score(frame(spark, [(held, "no training row")])).first()
    assert (r["n_known"], r["train_tokens"], r["n_tokens"]) == (0, 0, 4) and r["score"] < 0


def test_language_model_tables_grow_with_the_contexts(spark, monkeypatch):
    """Tables that start far too small win back most of what they would lose, and score in slot ranges as at once."""
    rng = random.Random(10)
    words = ["".join(rng.choice("abcdefghij") for _ in range(8)) for _ in range(6000)]
    docs = frame(spark, [(i, " ".join(rng.choice(words) for _ in range(100))) for i in range(300)])
    total = lambda: sum(r["score"] for r in lm_mixing.score(docs).collect())
    ample = total()
    small = [12] * lm_mixing.CONTEXTS
    monkeypatch.setattr(lm_mixing, "SLOT_BITS", small)
    assert lm_mixing.slot_bits([10**k for k in range(7, 7 + len(small))]) == [(4 * 10**k).bit_length() for k in range(7, 7 + len(small))]
    grown = total()
    with monkeypatch.context() as fixed:
        fixed.setattr(lm_mixing, "slot_bits", lambda pairs: small)
        assert grown - total() > 0.5 * (ample - total())
    monkeypatch.setattr(lm_mixing, "SENT_SLOTS", 1 << 16)
    monkeypatch.setattr(lm_mixing, "COUNT_SLOTS", 1 << 17)
    assert math.isclose(total(), grown, rel_tol=1e-6)


def test_low_orders_predict_and_weights_follow_a_whole_text():
    """Only the last byte's table knows anything; a long text goes on with what its first bytes taught the mixer."""
    tree = lm_mixing.code_trees(np.ones((256, 256), int))
    stream = np.frombuffer(b"ab" * 6000, np.uint8)
    begin = np.array([0, len(stream)])
    odds = [np.zeros(1 << b, np.float16) for b in lm_mixing.SLOT_BITS]
    none = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    blind = lm_mixing.Mixer(tree, odds, none).costs(stream, begin)[0]
    place, node, bit, _ = lm_mixing.decisions(lm_mixing.pairs_of(stream, begin), tree)
    odds[0][lm_mixing.slots(lm_mixing.SLOT_BITS[0], lm_mixing.context_hashes(stream, begin)[0], place, node)] = np.where(bit, 2, -2)
    mixer = lm_mixing.Mixer(tree, odds, none)
    assert 1 in lm_mixing.ORDERS and mixer.costs(stream, begin)[0] < 0.9 * blind
    head = [mixer.costs(stream[:n], np.array([0, n]))[0] for n in (4000, 8000, 12000)]
    assert head[1] - head[0] < 0.8 * head[0] and head[2] - head[1] < head[1] - head[0]


def test_costs_equal_a_plain_coder():
    """Bits of a few texts, coded bit by bit in plain Python from the definition of contexts, slots, gates and steps."""
    M = lm_mixing
    rng = np.random.default_rng(3)
    tree = M.code_trees(rng.integers(0, 9, (256, 256)))
    odds = [rng.normal(0, 2, 1 << b).astype(np.float16) for b in (12, 13, 14, 12)]
    texts = [b"\n", b"a bc\n", b"the cat and the dog " * 60 + b"\n", bytes(rng.integers(97, 101, 500).astype(np.uint8)) + b"\n"]
    stream = np.frombuffer(b"".join(texts), np.uint8)
    begin = np.cumsum([0] + [len(t) for t in texts])
    got = M.Mixer(tree, odds, (np.zeros(0, np.uint64), np.zeros(0, np.int64))).costs(stream, begin)
    words = M.context_hashes(stream, begin)[-1]  # hashes of spans have tests of their own
    for text, first, cost in zip(texts, begin, got):
        bits = []
        for i, byte in enumerate(text):
            past = b"\n" * 6 + text[:i]
            contexts = [int.from_bytes(past[: -k - 1 : -1], "little") << 16 for k in M.ORDERS] + [int(words[first + i])]
            pair = past[-1] * 256 + byte
            for step in range(tree[0][pair], tree[0][pair + 1]):
                x = []
                for c, table in zip(contexts, odds):
                    h = c * 0xC2B2AE3D27D4EB4F % 2**64
                    h = (h ^ h >> 32) * 0xD6E8FEB86659FD93 % 2**64
                    x.append(float(table[(h * len(table) >> 64) ^ int(tree[1][step]) % 256]))
                bits.append((x, sum(abs(x[-1]) > b for b in M.GATE_BOUNDS), 1 if tree[2][step] else -1))
        weights, scale, offset, total, low = [list(w) for w in M.START_WEIGHTS], 1.0, 0.0, 0.0, 0
        while low < len(bits):
            size = min(max(M.BLOCK, low // M.GROWTH), M.LONGEST)
            slower, moved, stretch, shift = (M.BLOCK / size) ** 0.5, [[0.0] * M.CONTEXTS for _ in weights], 0.0, 0.0
            for x, g, y in bits[low : low + size]:
                s = sum(a * b for a, b in zip(weights[g], x))
                p = 1 / (1 + math.exp(-y * (scale * s + offset)))
                total -= math.log2(p)
                miss = y * (1 - p)
                moved[g] = [m + miss * v for m, v in zip(moved[g], x)]
                stretch, shift = stretch + miss * s, shift + miss
            weights = [[w + M.RATE * slower * m for w, m in zip(*both)] for both in zip(weights, moved)]
            scale, offset = scale + M.REFINE_RATE * slower / M.BLOCK * stretch, offset + M.REFINE_RATE * slower * shift
            low += size
        assert math.isclose(cost, total, rel_tol=1e-5)


# --- licences ------------------------------------------------------------------------------


def test_license_rules(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this\nsoftware and associated documentation files (the \"Software\"), to deal in the\nSoftware without restriction.\n"
    notice = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    bsd = [s for n, s in licenses.SENTENCES if n.startswith("bsd")]
    rows = [
        (1, "text\nReleased under the MIT license!\nmore"),
        (2, f"Intro. {mit}\nA stranger.\n\n{notice}"),  # wrapped lines
        (3, f"{notice}\n\n{mit}"),  # wrong order
        (4, "\n".join(bsd)),
        (5, "\n".join([bsd[0], bsd[2]])),
        (6, None), (7, ""),
        (8, "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0. Licensed under CC BY 4.0.\n" + "word " * 20_000),
        (8, "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0. Licensed under CC BY 4.0.\n" + "word " * 20_000),
    ]
    got = {(r["doc_id"], r["license"]) for r in licenses.licenses(frame(spark, rows)).collect()}
    assert got == {(1, "MIT"), (2, "MIT"), (4, "BSD-3-Clause"), (5, "BSD-2-Clause"), (8, "Apache-2.0"), (8, "CC-BY-4.0")}
    assert licenses.licenses(frame(spark, [])).count() == 0


MIT_TEXT = """MIT License

Copyright (c) 2024 Some Author

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD_TEXT = """Copyright (c) 2024, Some Author

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

%sTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
BSD_NAME = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

"""


def test_unedited_license_texts(spark):
    rows = [(1, MIT_TEXT), (2, BSD_TEXT % ""), (3, BSD_TEXT % BSD_NAME)]
    got = {(r["doc_id"], r["license"], r["n_known"]) for r in licenses.licenses(frame(spark, rows)).collect()}
    assert got == {(1, "MIT", 4), (2, "BSD-2-Clause", 7), (3, "BSD-3-Clause", 8)}


# --- tool calls ----------------------------------------------------------------------------


def test_tool_calls(spark):
    calls = spark.createDataFrame(
        [
            ("c", "b", "add", '{"y": 2.5, "x": 1, "note": "é"}', 0),
            ("b", "a", "add", '{"x": 1}', 0),
            ("a", None, "add", '{"x": "1", "y": 1, "z": 0}', 0),
            ("a", None, "add", '{"x": "1", "y": 1, "z": 0}', 1),
            ("p", "q", "add", '{"x": 1, "y": 1}', 0),
            ("q", "p", "add", "[1]", 0),
            ("o", "nowhere", "none", "{}", 0),
            (None, "a", "add", "no json", 0),
        ],
        "call_id string, follows string, name string, arguments string, depth int",
    )
    results = spark.createDataFrame([("a", "2"), ("a", "1"), ("zz", "x"), (None, "x")], "call_id string, content string")
    fields = [("x", "integer", True), ("y", "number", True), ("note", "string", False)]
    schemas = spark.createDataFrame([("add", fields)], tool_calls.SCHEMA_FIELDS)
    got = {r["call_id"]: r for r in tool_calls.link_calls(calls, results, schemas).collect()}
    assert {k: r["depth"] for k, r in got.items()} == {"a": 0, "b": 1, "c": 2, "p": None, "q": None, "o": 0, None: 0}
    assert {k: r["errors"] for k, r in got.items()} == {
        "a": "type x; unknown z", "b": "missing y", "c": "", "p": "cycle", "q": "arguments are no object; cycle", "o": "unknown tool", None: "arguments are no object",
    }
    assert (got["a"]["n_calls"], got["a"]["n_results"]) == (2, 2)
    assert got["c"]["message"] == '{"arguments":{"note":"é","x":1,"y":2.5},"id":"c","name":"add"}'
    assert json.loads(got["a"]["message"])["result"] == "1"


def test_deep_call_chain(spark):
    calls = spark.createDataFrame([(str(i), str(i - 1) if i else None) for i in range(300)], "call_id string, follows string")
    assert {(r["call_id"], r["depth"]) for r in tool_calls.depths(calls).collect()} == {(str(i), i) for i in range(300)}


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string, depth int")
    assert tool_calls.link_calls(*tool_calls.turn_calls(empty)).count() == 0


# --- decontamination -----------------------------------------------------------------------


def test_containment(spark):
    rng = random.Random(1)
    words = [f"w{k}" for k in range(3000)]
    item = " ".join(rng.choice(words) for _ in range(40))
    other = " ".join(rng.choice(words) for _ in range(4000))
    half = " ".join(item.split()[:20])
    most = item.split()
    most[0] = "changed"
    bench = spark.createDataFrame([(1, item, 0), (2, "Three short words", 0), (3, None, 0), (4, "", 0), (1, item, 0)], "item_id bigint, text string, doc_id int")
    rows = [(1, other + " " + item.upper() + " " + other), (2, half), (3, " ".join(most)), (4, "has three   short words inside"), (5, None), (6, "three words"), (None, item)]
    for block in (1, 200_000):
        got = sorted(((r["item_id"], r["doc_id"], r["shared"], r["item_shingles"]) for r in decontamination.contained_items(frame(spark, rows), bench, block_shingles=block).collect()), key=repr)
        assert got == sorted([(1, 1, 36, 36), (1, 3, 35, 36), (1, None, 36, 36)] * 2 + [(2, 4, 1, 1)], key=repr)
    clean = decontamination.clean_documents(frame(spark, rows), bench)
    assert clean.columns == frame(spark, []).columns and {r["doc_id"] for r in clean.collect()} == {2, 5, 6, None}
    assert decontamination.contained_items(frame(spark, rows), bench.limit(0)).count() == 0
    assert decontamination.contained_items(frame(spark, []), bench).count() == 0


# --- mixing --------------------------------------------------------------------------------


def test_mix_meets_its_budgets(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(60), rng.choice("aaaaabcdé") if i % 9 else None) for i in range(3000)] + [(5000, None, "empty"), (5001, "", "empty")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("size", F.lit("x")).withColumn("taken", F.lit("x"))
    got = mixing.mix(docs, range_rows=100).collect()
    assert sorted(got) == sorted(mixing.mix(docs.repartition(3), range_rows=100).collect())
    per = collections.defaultdict(lambda: [0, 0])
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        per[r["source"]][0] += r["taken"]
        per[r["source"]][1] = (r["target"], r["source_size"])
    assert all(taken == round(target) and target <= 3 * size for taken, (target, size) in per.values())
    assert round(sum(t for _, (t, _) in per.values())) == sum(r["size"] for r in got)
    assert mixing.mix(docs.limit(0)).count() == 0


# --- toxicity ------------------------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(4)
    plain, bad = [f"word{k}" for k in range(300)], ["vile", "nasty", "foul"]
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(plain) for _ in range(rng.randrange(20, 80))]
        if i % 4 == 0:
            words += [rng.choice(bad) for _ in range(6)]
            rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0), None))
    labels += [(None, 1, None), (7, None, None), (10**6, 1, None)]
    table = spark.createDataFrame(labels, "doc_id bigint, toxic int, score string")
    docs = frame(spark, rows + [(1000, None), (1001, ""), (None, "word1 word2")])
    got = {r["doc_id"]: r for r in toxicity.score(docs, table).collect()}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i]["predicted"] == (i % 4 == 0) for i in held) >= 0.95 * len(held)
    assert got[1000]["score"] == got[1001]["score"] and all(0 <= r["score"] <= 1 for r in got.values())
    # Labels of held-out rows are never read.
    turned = table.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {r["doc_id"]: r["score"] for r in toxicity.score(docs, turned).collect()} == {i: r["score"] for i, r in got.items()}
    assert toxicity.score(docs, table.filter("toxic = 1")).select("score").distinct().collect() == [(1.0,)]
    assert toxicity.score(docs.limit(0), table).count() == 0
    clean = toxicity.clean_documents(docs, table)
    assert clean.columns == docs.columns and clean.count() == sum(r["predicted"] == 0 for r in got.values())


# --- line dedup ----------------------------------------------------------------------------


def test_lines_of_awkward_rows(spark):
    rows = awkward() + [(20 + k, "shared line of text\nÀ own " + str(k) + " padding\n  SHARED line of text\t") for k in range(40)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = line_dedup.line_dedup(frame(spark, rows)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    key = lambda line: line.encode().lower().strip(b" \t\n\r\x0b\x0c").decode()
    rank = lambda i: 2**63 if i is None else i
    held = collections.defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                held[key(line)].add(rank(i))
    want = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 10 and len(held[key(x)]) > 1 and min(held[key(x)]) != rank(i))]
        want.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert line_dedup.line_dedup(frame(spark, [])).count() == 0


# --- near dedup ----------------------------------------------------------------------------


@pytest.mark.parametrize("pack", [400_000, 600])
def test_near_dedup_equals_brute_force(spark, pack):
    """Families of edited copies; with small packs the large family is cut into chunks."""
    rng = random.Random(5)
    words = [f"w{k}" for k in range(5000)]
    rows, i = [], 0
    for size in (60, 12, 3, 3, 1, 1):
        text = [rng.choice(words) for _ in range(120)]
        for _ in range(size):
            own = list(text)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((i, " ".join(own)))
            i += 1
    rows += [(1000 + i, t) for i, t in awkward() if i not in (None, 9)]
    rng.shuffle(rows)
    got = {tuple(r) for r in near_dedup.near_dedup(frame(spark, rows), pack=pack).collect()}
    assert got == components_by_brute_force(rows, 85)


def test_near_dedup_of_the_given_table(spark):
    got = {tuple(r) for r in QUERIES["op9_near_dedup"].run(spark, FOLDER).collect()}
    assert got == components_by_brute_force(given(spark), 85)


def test_near_dedup_of_null_ids_and_repeats(spark):
    text = "a b c d e f g h"
    got = near_dedup.near_dedup(frame(spark, [(5, text), (5, text), (None, text), (7, text), (None, "other words"), (8, None)])).collect()
    assert sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in got), key=repr) == sorted([(5, 5, True)] * 2 + [(None, 5, False), (7, 5, False), (None, None, True), (8, 8, True)], key=repr)
    assert near_dedup.near_dedup(frame(spark, [])).count() == 0


def test_joint_estimate_is_near_the_similarity():
    rng = np.random.default_rng(6)
    for share in (0.2, 0.5, 0.9):
        same, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (int(20_000 * share), int(10_000 * (1 - share)), int(10_000 * (1 - share))))
        sets = [np.concatenate((same, x)) for x in (a, b)]
        regs = near_dedup.registers(np.concatenate(sets), np.array([0, len(sets[0])]))
        n = [float(len(s)) for s in sets]
        got = near_dedup.joint_estimate(regs[0], regs[1:], np.float64(n[0]), np.array([n[1]]))[0]
        assert abs(got - len(same) / (len(same) + len(a) + len(b))) < 0.2


def test_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(50)] + [(100, 101), (7, 7), (60, 55), (55, 60)], "a bigint, b bigint")
    want = {k: 0 for k in range(51)} | {100: 100, 101: 100, 55: 55, 60: 55}
    assert {r["node"]: r["component"] for r in components(edges).collect()} == want
    assert components(edges.limit(0)).count() == 0


# --- suffix dedup --------------------------------------------------------------------------


def test_suffix_order():
    rng = random.Random(7)
    for _ in range(300):
        limit = rng.choice([1, 5, 8, 10, 17, 70, 100])
        raw = bytes(rng.choice(rng.choice([b"a", b"ab", b"abc"])) for _ in range(rng.randint(limit + 1, 400))) * rng.choice([1, 3])
        starts = np.array(rng.sample(range(len(raw) - limit + 1), min(len(raw) - limit + 1, 50)))
        order, same = suffix_order(np.frombuffer(raw, np.uint8), starts, limit)
        keys = [raw[starts[i] : starts[i] + limit] for i in order]
        assert keys == sorted(keys) and same.tolist() == [False] + [a == b for a, b in zip(keys, keys[1:])]


@pytest.mark.parametrize("hot", [5000, 2])
def test_repeats_equal_brute_force(spark, hot):
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdefé \n") for _ in range(n))
    shared = [text(n) for n in (150, 90, 400)]
    rows = [(i, text(rng.randrange(200)) + (rng.choice(shared) if i % 2 else "") + text(rng.randrange(200))) for i in range(60)]
    rows += [(100, "ab" * 300), (101, None), (102, ""), (103, "short"), (104, "x" * 79), (105, shared[0][:79]), (106, shared[0][:80]), (107, rows[3][1]), (107, rows[3][1]), (None, text(300))]
    got = suffix_dedup.remove_repeats(frame(spark, rows), match=80, hot=hot, pack=20).collect()
    assert sorted(((*r[:4], bytes(r["kept"])) for r in got), key=repr) == repeats_by_brute_force(rows, 80)


def test_repeats_of_the_given_table(spark):
    got = QUERIES["op10_repeat_removal"].run(spark, FOLDER).collect()
    want = [(i, n, gone, runs, hashlib.sha256(kept).hexdigest()) for i, n, gone, runs, kept in repeats_by_brute_force(given(spark), 400)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0


# --- pipeline ------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    """Each stage but the trained one against brute force on what its predecessor kept."""
    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    bench = [(r["item_id"], fold(r["text"])) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = [docs]
    for _, function in pipeline.STAGES:
        kept.append(function(spark, kept[-1], FOLDER))
    assert all(d.columns == docs.columns for d in kept[:-1])
    rows = [{r["doc_id"]: r["text"] for r in d.select("doc_id", "text").collect()} for d in kept[:-1]]
    gone = set(rows[0]) - set(rows[1])
    assert sum(toxic.get(i, 0) for i in gone) >= 0.7 * sum(1 for i in gone if i in toxic)
    first = {}
    for i, t in sorted(rows[1].items()):
        first.setdefault(" ".join(__import__("re").split("[\x20\x09-\x0d]+", t)), i)
    assert set(rows[2]) == set(first.values())
    assert set(rows[3]) == {i for i, _, _, k in components_by_brute_force(rows[2].items(), 85) if k}

    def leaks(text):
        w = fold(text)
        held = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        return any(sum(s in held for s in own) * 100 >= 80 * len(own) for own in ({tuple(b[k : k + 5]) for k in range(len(b) - 4)} for _, b in bench) if own)

    assert set(rows[4]) == {i for i, t in rows[3].items() if not leaks(t)}
    last = kept[-1].collect()
    assert {r["doc_id"] for r in last} <= set(rows[4]) and all(0 < r["taken"] <= 3 * r["size"] for r in last)
