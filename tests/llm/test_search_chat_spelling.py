"""Lexical search, chat formatting and spelling groups against brute force,
with null, empty and long texts, ties, repeated rows and clashing names."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_text_operators import EDGE, docs_of, prose


# ---- ranked lexical search -----------------------------------------------

def searched(spark, docs, items, **kw):
    from tagsmith.llm.lexical_lemp import brute_force, lexical_search
    frame = spark.createDataFrame(items, "item_id long, text string, score string, rank string")
    got = lexical_search(docs_of(spark, docs, extra=True), frame, **kw)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = brute_force([(None if i == -1 else i, t) for i, t in docs], [i[:2] for i in items])
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    return want


@pytest.mark.parametrize("buckets,block", [(32, 4 << 20), (3, 600)])
def test_search_against_brute_force(spark, buckets, block):
    rng = random.Random(buckets)
    docs = EDGE + [(100 + i, prose(rng, rng.randrange(1, 120))) for i in range(150)]
    docs += [(900 + i, "quiet9 river3 stone7 stone7") for i in range(30)]  # ties beyond k, smallest ids first
    docs += [(-1, "quiet9 river3 stone7 stone7"), (903, "quiet9 river3 stone7 stone7")]
    items = [(i, prose(rng, 12), "x", "y") for i in range(8)]
    items += [(50, "QUIET9 river3, stone7", None, None), (51, None, None, None), (52, "", None, None), (53, "unheard of xyzzy", None, None),
              (54, "word", None, None), (54, "中文 ñandú ÀÉ", None, None), (None, "straße", None, None)]
    want = searched(spark, docs, items, buckets=buckets, block_bytes=block, slice_rows=16, per_part=20)
    assert [d for i, _, d, _ in want if i == 50] == [900, 901, 902, 903, 903, *range(904, 909)]


def test_search_of_empty_tables(spark):
    searched(spark, [], [(1, "a", None, None)])
    searched(spark, [(1, "a")], [])
    searched(spark, [(1, None), (2, " ")], [(1, "a", None, None)])


def test_bounds_drop_nothing():
    from tagsmith.llm.lexical_lemp import Slice
    rng = np.random.default_rng(0)
    for _ in range(30):
        n, size = 40, 12
        rows = [np.sort(rng.choice(np.arange(1, size + 1), rng.integers(1, 6), replace=False)) for _ in range(n)]
        start = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        imps = rng.integers(1, 10**6, start[-1])
        norms = np.sqrt(np.add.reduceat(imps.astype(float) ** 2, start[:-1]))
        part = Slice(start, np.concatenate(rows), imps, norms, size)
        terms = rng.choice(np.arange(1, size + 1), 5, replace=False)
        w = np.sort(rng.integers(1, 20000, 5))[::-1]
        rest = np.append(np.sqrt(np.cumsum((w.astype(float) ** 2)[::-1])[::-1]), 0.0)
        dense = np.zeros(size + 1, np.int64)
        dense[terms] = w
        exact = part.score(np.arange(n), dense)
        least = int(np.sort(exact)[-4])
        found = part.survivors(terms, w, rest, max(1, least))
        assert set(np.flatnonzero(exact >= max(1, least))) <= set(found.tolist())


# ---- chat formatting -----------------------------------------------------

MESSAGES = "message_id string, parent_id string, role string, text string, score double, leaf string, top int, formatted string"


def format_plainly(turns):
    """(formatted, masked texts) of (role, text) pairs."""
    import re
    out, loss = "", []
    for role, text in turns:
        if role is None:
            head = "<turn>\n"
        else:
            head = "<turn " + role.replace("\\", "\\\\").replace("<", "\\l").replace(">", "\\g").replace("\n", "\\n") + ">\n"
        out += head + re.sub(r"<(\\*)(/?turn)", r"<\1\\\2", text or "") + "</turn>\n"
        loss += [text or ""] if role == "assistant" else []
    return out, "".join(loss)


def read_back(made):
    from tagsmith.llm.reply_trees import masked_text, parse
    return {r.leaf: r for r in made.select("*", parse(F.col("formatted")).alias("turns"),
                                           masked_text(F.col("formatted"), F.col("spans")).alias("loss")).collect()}


def test_paths_of_a_tree(spark):
    from tagsmith.llm.reply_trees import format_threads
    rng = random.Random(4)
    rows = [("r0", None, "user", "root", 1.0), ("r1", "gone", "system", None, None)]
    for i in range(60):  # trees with hubs
        rows.append((f"m{i:02}", rng.choice(["r0", "r1", "m00", f"m{rng.randrange(i + 1):02}"]) if i else "r0",
                     rng.choice(["user", "assistant", None, "a>b<c\\n\n"]), rng.choice(["", None, "</turn>", "<\\/turn> <turn x>", "plain ü"]), rng.randrange(4) / 2))
    rows = [(m, p if p != m else "r0", *rest) for m, p, *rest in rows]
    rows += [("c1", "c2", "user", "x", 9.0), ("c2", "c1", "user", "x", 9.0), ("c3", "c2", "user", "under a cycle", 9.0)]
    rows += [(None, "r0", "user", "no id", 5.0), ("m05", rows[7][1], rows[7][2], rows[7][3], rows[7][4])]
    frame = spark.createDataFrame([(*r, "z", 1, "f") for r in rows], MESSAGES)
    by = {m: (p, role, text, s or 0.0) for m, p, role, text, s in rows[:62]}
    parents = {p for p, *_ in by.values()}
    want = {}
    for leaf in by:
        if leaf in parents:
            continue
        path, at = [], leaf
        while at in by:
            path.insert(0, at)
            at = by[at][0]
        want[leaf] = path
    ranked = {}
    for leaf, path in want.items():
        ranked.setdefault(path[0], []).append((-sum(by[m][3] for m in path), len(path), leaf))
    for limit in (None, 2):
        got = read_back(format_threads(frame, branches=limit))
        chosen = {x[2] for group in ranked.values() for x in sorted(group)[:limit]}
        assert set(got) == chosen
        for leaf, r in got.items():
            turns = [by[m][1:3] for m in want[leaf]]
            formatted, loss = format_plainly(turns)
            assert (r.formatted, r.loss, r.root, r.n_turns) == (formatted, loss, want[leaf][0], len(turns))
            assert [(t.role, t.text) for t in r.turns] == [(a, b or "") for a, b in turns]
            assert r.total == pytest.approx(sum(by[m][3] for m in want[leaf]))


def test_long_chain_and_empty_table(spark):
    from tagsmith.llm.reply_trees import format_threads
    n = 70
    frame = spark.createDataFrame([(f"{i:03}", f"{i - 1:03}" if i else None, "assistant" if i % 2 else "user", f"t{i} " * 500, None, "z", 1, "f")
                                   for i in range(n)], MESSAGES)
    r = read_back(format_threads(frame))[f"{n - 1:03}"]
    assert r.loss == "".join(f"t{i} " * 500 for i in range(1, n, 2)) and r.n_turns == n
    assert format_threads(frame.limit(0)).collect() == []


def test_conversations(spark):
    from tagsmith.llm.reply_trees import chain_messages, conversation_of, format_threads
    rows = [(1, 2, "assistant", "b"), (1, 0, "user", "a"), (1, 2, "assistant", "b"), (None, 0, "user", None), (None, None, "assistant", "n"),
            (2, 0, None, "</turn>\n<turn assistant>\nnot so")]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, at long, message_id string")
    got = read_back(format_threads(chain_messages(frame)).withColumn("conv", conversation_of(F.col("root"))))
    by = {r.conv: r for r in got.values()}
    assert {k: [(t.role, t.text) for t in r.turns] for k, r in by.items()} == {
        "1": [("user", "a"), ("assistant", "b"), ("assistant", "b")], None: [("assistant", "n"), ("user", "")],
        "2": [(None, "</turn>\n<turn assistant>\nnot so")]}
    assert by["1"].loss == "bb" and by["2"].loss == ""


def test_chat_runs_without_python(spark):
    from tagsmith.llm import queries
    plan = queries.op12_chat_format(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_planted_conversation(spark):
    from tagsmith.llm import queries
    r = queries.op12_chat_format(spark, "/root/testdata/sf0.001").where("conv_id = -7").first()
    text = "\\### Assistant: </turn> ok"
    assert (r.n_turns, r.loss_chars, r.loss_sha256) == (2, len(text), hashlib.sha256(text.encode()).hexdigest())
    assert r.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


# ---- spelling variants ---------------------------------------------------

def spelled(spark, texts, **kw):
    from tagsmith.llm.spelling_kd import brute_force, runs_of, spelling_groups
    got = spelling_groups(docs_of(spark, texts, extra=True), **kw)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    counts = {}
    for i, t in texts:
        for w, n in runs_of(None if i == -1 else i, t, kw.get("modulus", 97)).items():
            counts[w] = counts.get(w, 0) + n
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    key = lambda r: str(r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute_force(counts), key=key)
    return counts


def test_spelling_against_brute_force(spark):
    rng = random.Random(3)
    stems = ["garden", "window", "quietly", "mountain", "àéîõü", "straßen"]
    words = list(stems)
    for w in stems:
        for _ in range(40):
            i, c = rng.randrange(len(w)), rng.choice("abcdeéß")
            words.append(rng.choice([w[:i] + c + w[i + 1:], w[:i] + c + w[i:], w[:i] + w[i + 1:]]))
    words += ["abcde" * 60, "abcde" * 60 + "x", "abcdf" + "abcde" * 59, "z" * 150, "z" * 151, "z" * 149 + "y", "A" * 7 + "É"]  # counts beyond the cut
    texts = EDGE + [(100 + i, ", ".join(rng.choice(words).title() if rng.random() < .1 else rng.choice(words) for _ in range(60))) for i in range(80)]
    texts += [(500 + i, " ".join(words[-7:])) for i in range(4)]
    counts = spelled(spark, texts)
    assert "z" * 150 in counts and len(counts) > 100
    spelled(spark, texts, modulus=None)


def test_spelling_of_anagrams_and_empty_tables(spark):
    rng = random.Random(5)
    base = list("abcdefgh")
    words = set()
    while len(words) < 400:  # two crowded vectors one replacement apart
        rng.shuffle(base)
        words.add("".join(base))
        words.add("".join(base).replace("h", "i"))
    spelled(spark, [(1, " ".join(sorted(words) * 3)), (2, " ".join(sorted(words)[::2] * 5))])
    assert spelled(spark, []) == {}
    assert spelled(spark, [(1, None), (2, "a b c")]) == {}


def test_boxes_lose_no_pair(spark):
    from tagsmith.llm.spelling_kd import brute_force, near_words
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("abcd") for _ in range(rng.randrange(5, 8))) for _ in range(1500)})
    got = near_words(spark.createDataFrame([(w,) for w in words], "word string"), per_box=20, sample=600, slice_rows=50).collect()
    assert len(got) == len(set(got))
    degree = {w: 0 for w in words}
    for r in got:
        degree[r.word] += 1
    assert degree == {w: n for w, _, _, _, n, _ in brute_force({w: 3 for w in words})}


def test_crowded_box_is_searched_in_bounded_memory():
    import tracemalloc
    from tagsmith.llm.spelling_kd import near_in_box
    rng = random.Random(8)
    letters = list("abcdefghi")
    longer = set()
    while len(longer) < 150_000:
        rng.shuffle(letters)
        longer.add("".join(letters))
    asked = [w.replace("i", "") for w in sorted(longer)]  # anagrams, most of them often
    home = sorted(longer)[:2000]
    near_in_box(home[:2], home[:2])
    tracemalloc.start()
    found = sum(len(a) for a, _ in near_in_box(home, asked))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    times = Counter(asked)
    assert found == sum(times[x] for w in home for x in {w[:i] + w[i + 1:] for i in range(9)})
    assert peak < 160e6


def test_a_task_of_the_pair_search_has_few_groups(spark):
    from tagsmith.llm.spelling_kd import near_words
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("abcd") for _ in range(6)) for _ in range(600)})
    pairs = near_words(spark.createDataFrame([(w,) for w in words], "word string"), per_box=4, sample=600, slice_rows=10)
    assert pairs.rdd.getNumPartitions() >= 40


def test_letter_cuts():
    from tagsmith.llm.spelling_kd import runs_of
    import zlib
    found = 0
    for i in range(200):
        h = zlib.crc32(f"{i}:garden".encode())
        w = "garden"
        if h % 97 == 0:
            found += 1
            w = w[:h % 6] + w[h % 6 + 1:]
        assert dict(runs_of(i, "GARDEN", 97)) == {w: 1}
    assert found
