import os
import re
import unicodedata
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from stockpot.llm import canonical_text as T
from stockpot.llm.canonical_list import NONE, map_lines, map_values
from stockpot.llm.cooccurrence import cooccurrence, gram
from stockpot.llm.current import current_rows
from stockpot.llm.dartminhash import bands, signatures
from stockpot.llm.mixing import mix, quotas, shares, split_quotas
from stockpot.llm.near_duplicates import MAPPED, SIZED, _may_be_similar, classes_and_links, may_be_similar, near_duplicates, shingle_sets, signed_sets, signed_texts, sketches, word_and_item_sets
from stockpot.llm.packing import pack
from stockpot.llm.queries import QUERIES
from stockpot.llm.terms import mark, term_frequency
from stockpot.llm.token_counts import VOCABULARY, tokenizer, with_token_counts


def test_current_rows(spark):
    rows = spark.createDataFrame([(1, 2, "new"), (1, 1, "old"), (1, 2, "new"), (2, None, "x")], "recipe_no long, revision int, name string")
    assert {tuple(r) for r in current_rows(rows, "name").collect()} == {(1, "new"), (2, "x")}
    assert current_rows(rows.limit(0), "name").count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), max_size=12), max_size=30), st.integers(1, 8))
def test_gram_equals_counting(baskets, dense):
    import stockpot.llm.cooccurrence as M

    before, M.DENSE, entries, M.ENTRIES = M.DENSE, dense, M.ENTRIES, 7
    try:
        codes = np.array([x for b in baskets for x in sorted(b)], np.int64)
        if not len(codes):
            return
        a, b, n = gram(codes, np.array([len(b) for b in baskets], np.int64), 31)
    finally:
        M.DENSE, M.ENTRIES = before, entries
    got = Counter()
    for x, y, m in zip(a, b, n, strict=True):
        got[min(x, y), max(x, y)] += int(m)
    want = Counter(p for s in baskets for p in [*combinations(sorted(s), 2), *((x, x) for x in s)])
    assert got == want


def test_cooccurrence(spark):
    rows = [(["A ", "b", "b", None, " "], None, "x")] * 3 + [(["a", "c"], ["t", "u"], "x"), (None, [], "x")]
    records = spark.createDataFrame(rows, "items array<string>, tags array<string>, item_kind string")
    got = {(r.item_kind, r.item_a, r.item_b): (r.n_ab, r.n_a, r.n_b, r.n_records, round(r.lift, 4)) for r in cooccurrence(records, {"i": "items", "t": "tags"}).collect()}
    assert got == {("i", "a", "b"): (3, 4, 3, 5, 1.25), ("i", "a", "c"): (1, 4, 1, 5, 1.25), ("t", "t", "u"): (1, 1, 1, 5, 5.0)}
    assert set(cooccurrence(records, {"i": "items"}, min_count=2).select("item_b").toPandas()["item_b"]) == {"b"}
    assert cooccurrence(records.limit(0), {"i": "items"}).count() == 0


def test_blocks_are_bounded_by_their_items():
    import pyarrow as pa
    import stockpot.llm.cooccurrence as M

    batch = pa.RecordBatch.from_arrays([pa.array([["a", "b"], None, ["a", "c"], [], ["b", "c", "d"], ["a", "b"]], pa.list_(pa.string()))], ["_0"])
    want = Counter()
    for lists in batch.column(0).to_pylist():
        want.update((*p,) for p in [*combinations(lists or [], 2), *((x, x) for x in lists or [])])
    before, M.ITEMS = M.ITEMS, 3
    try:
        assert all(M._items(p) <= 3 or p.num_rows == 1 for p in M._pieces(batch))
        got = Counter()
        for out in M._products(["k"])(iter([batch, batch.slice(0, 0)])):
            for r in out.to_pylist():
                got[r["item_a"], r["item_b"]] += r["n"]
    finally:
        M.ITEMS = before
    assert got.pop(("", "")) == 6 and got == want


def test_pairs_of_few_recipes_come_out(spark, tmp_path):
    rows = [(1, 1, ["a", "b"]), (2, 1, ["a", "b"]), (3, 1, ["b", "c"]), (4, 1, ["c"]), (4, 2, ["a", " C "])]
    records = spark.createDataFrame([(no, rev, items, None, []) for no, rev, items in rows], "recipe_no long, revision int, ingredient_names array<string>, tag_slugs array<string>, category_slugs array<string>")
    records.write.parquet(f"{tmp_path}/recipe_summary.parquet")
    assert {(r.item_a, r.item_b, r.n_ab) for r in QUERIES["p1_pairs"](spark, str(tmp_path)).collect()} == {("a", "b", 2), ("b", "c", 1), ("a", "c", 1)}
    assert QUERIES["p1_found"](spark, str(tmp_path)).count() == 0


def test_term_frequency(spark):
    import stockpot.llm.terms as M

    rng = np.random.default_rng(3)
    rows = [("f", f"t{int(t)}" if t < 40 else "", f"r{int(r)}") for t, r in zip(rng.zipf(1.3, 3000) % 50, rng.integers(0, 60, 3000), strict=True)]
    rows += [("f", "hot", "00000000-0000-5000-8000-000000000000")] * 1500 + [("f", None, "r1"), ("f", "x", None), ("g", "hot", "r1"), ("f", "long" * 5000, "r1")]
    long = spark.createDataFrame([(*r, 1) for r in rows], "field_name string, term string, record string, records int")
    got = {(r.field_name, r.term): (r.occurrences, r.records) for r in term_frequency(long, share=0.01).collect()}
    kept = [r for r in rows if None not in r]
    n, d = Counter(r[:2] for r in kept), Counter(r[:2] for r in set(kept))
    assert got == {k: (n[k], d[k]) for k in n}
    assert term_frequency(long.limit(0)).count() == 0
    # records that many batches and partitions hold in parts
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    before, M.GATHERED = M.GATHERED, 20
    try:
        parted = {(r.field_name, r.term): (r.occurrences, r.records) for r in term_frequency(long.repartition(5), share=0.01).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        M.GATHERED = before
    assert parted == got
    marks = spark.createDataFrame([(4,), (5,), (10,), (11,)], "n long").select(mark(F.col("n"), 100)).collect()
    assert [r[0] for r in marks] == ["rare", None, None, "common"]


ENTRIES = ["salt", "sea salt", "yellow onion", "fermented rambutan", "roasted guava", "half and half", "celery stalk", "cinnamon", "squid", "egg", "rolled oats", "bay leaf", "water", "butter"]


@pytest.fixture(scope="module")
def mapped(spark):
    typed = [
        "SALT ", "sált", "salts", "Sea  salt", "table salt", "onion yellow", "yellow-onion", "fermented rambutannn", "roasted durian", "fermented guava", "celeryestall or more", "squid ink", "cinnamon roll", "egs",
        "Topogi salt", "Topogi yellow onion", "Topogi organic squid", "best eggs (optional)", "bay leaves", "zugu", "", "half nd half", "rplledoats", "salt * - divided", "x" * 5000, "some gárlic salt",
    ]
    entries = spark.createDataFrame([(f"id-{n}", n, 1) for n in ENTRIES] + [("id-salt", "table salt", 1), ("id-none", None, 1), (None, "x", 1)], "target string, name string, score int")
    values = spark.createDataFrame([(t, 9) for t in [*typed, None, "SALT "]], "value string, target int")
    rows = map_values(values, entries).collect()
    assert len(rows) == len(typed)
    return {r.value: r.target for r in rows}


def test_typed_values(mapped):
    want = {
        "SALT ": "salt", "sált": "salt", "salts": "salt", "Sea  salt": "sea salt", "table salt": "salt", "onion yellow": "yellow onion", "yellow-onion": "yellow onion", "fermented rambutannn": "fermented rambutan",
        "celeryestall or more": "celery stalk", "egs": "egg", "Topogi salt": "salt", "Topogi yellow onion": "yellow onion", "Topogi organic squid": "squid", "best eggs (optional)": "egg", "bay leaves": "bay leaf",
        "half nd half": "half and half", "rplledoats": "rolled oats", "salt * - divided": "salt",
    }
    assert {k: v for k, v in mapped.items() if v != NONE} == {k: f"id-{v}" for k, v in want.items()}


def test_tokens_of_any_length_are_repaired(spark):
    import random

    from stockpot.llm.canonical_list import _repair

    draw = random.Random(3)
    letters = "abcdefgh"
    forms = ["".join(draw.choice(letters) for _ in range(n)) for n in (1, 2, 3, 4, 5, 7, 12, 46, 47, 48, 49, 50, 51, 90, 91, 300)]

    def edited(word, n):
        for _ in range(n):
            at, how = draw.randrange(len(word) + 1), draw.choice("idsw")
            if how == "i":
                word = word[:at] + draw.choice(letters) + word[at:]
            elif how == "d":
                word = word[:at] + word[at + 1 :]
            elif how == "s":
                word = word[:at] + draw.choice(letters) + word[at + 1 :]
            else:
                word = word[:at] + word[at : at + 2][::-1] + word[at + 2 :]
        return word

    typed = sorted({w for f in forms for n in (0, 1, 1, 2, 2, 2, 3) for _ in range(12) if (w := edited(f, n))})
    words = spark.createDataFrame([(t,) for t in typed], "token string")
    vocabulary = spark.createDataFrame([(f, [f], 0) for f in forms], "form string, refs array<string>, inflected int")
    got = {(r.token, r.ref): r.edits for r in _repair(words, vocabulary).collect()}

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    want = {}
    for t in typed:
        for f in forms:
            if abs(len(t) - len(f)) > 2:
                continue
            d = distance(t, f)
            swap = len(t) == len(f) and any(t[:i] + t[i + 1] + t[i] + t[i + 2 :] == f for i in range(len(t) - 1))
            d = 1 if d == 2 and swap else d
            if d <= (0 if d == 0 or max(len(t), len(f)) <= 2 else 1 if max(len(t), len(f)) <= 4 else 2):
                want[t, f] = d
    assert got == want and len(want) > 400


def test_ties_go_to_the_smaller_target(spark):
    entries = spark.createDataFrame([("id-2", "salt pork"), ("id-1", "pork salt"), ("id-3", "salt pork")], "target string, name string")
    values = spark.createDataFrame([("salt pork",)], "value string")
    assert [r.target for r in map_values(values, entries).collect()] == ["id-1"]
    swaps = spark.createDataFrame([("slat", "salt"), ("atls", "salt"), ("salt", "salt"), ("last", "salt"), ("x", "x")], "a string, b string")
    from stockpot.llm.canonical_list import _swapped

    assert [r[0] for r in swaps.select(_swapped(F.col("a"), F.col("b"))).collect()] == [True, False, False, False, False]


def test_stray_lines(spark):
    kind = "line_id long, ingredient_id string, name string, normalized_name string, loaded_at timestamp, score int"
    lines = spark.sql("select 1L line_id, cast(null as string) ingredient_id, 'salt' name, 'salt' normalized_name, timestamp'2024-01-01' loaded_at, 1 score").union(
        spark.sql("select 1L, null, 'salts', 'x', timestamp'2024-01-02', 1 union all select 2L, 'id-salt', 'x', 'x', timestamp'2024-01-02', 1 union all select 3L, 'unknown', null, null, null, 1")
    )
    assert lines.schema.simpleString().count("string") == kind.count("string")
    entries = spark.createDataFrame([("id-salt", "salt")], "target string, name string")
    index = entries.select(F.col("target").alias("id"))
    assert {(r.line_id, r.ingredient_id) for r in map_lines(lines, entries, index).collect()} == {(1, "id-salt"), (3, NONE)}
    assert map_lines(lines.limit(0), entries, index).count() == 0


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    common, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (120, 40, 40))
    elements = np.concatenate([common, a, common, b])
    weights = np.concatenate([np.full(120, 2.0), np.full(40, 1.5), np.full(120, 2.0), np.full(40, 1.5)])
    plain = np.mean([np.mean(np.equal(*signatures(elements, np.array([160, 160]), 256, seed=s))) for s in range(20)])
    heavy = np.mean([np.mean(np.equal(*signatures(elements, np.array([160, 160]), 256, weights, seed=s))) for s in range(20)])
    assert abs(plain - 120 / 200) < 0.03 and abs(heavy - 240 / 360) < 0.03
    assert (signatures(elements[:3], np.array([0, 3]), 64)[0] == 2**64 - 1).all()
    assert bands(signatures(elements[:3], np.array([3]), 64), 40, 4).shape == (1, 40)


def _jaccard_pairs(sets, threshold):
    return {(a, b) for a, b in combinations(sorted(sets), 2) if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold}


def test_near_duplicate_texts(spark):
    rng = np.random.default_rng(5)
    texts = {}
    for g in range(40):
        base = [f"w{int(x)}" for x in rng.integers(0, 300, 60)]
        for k in range(4):
            own = list(base)
            for _ in range(k):
                own[int(rng.integers(0, 60))] = f"z{int(rng.integers(0, 1000))}"
            texts[len(texts)] = " ".join(own)
    texts |= {1000: "", 1001: "one two", 1002: "same words here", 1003: "Same, words HERE", 1004: "a b " * 20000, 1005: "a b " * 20001}
    rows = spark.createDataFrame([(k, t, 1) for k, t in texts.items()] + [(7, texts[7], 1), (None, "x y z", 1), (9999, None, 1)], "doc_id long, text string, members int")
    words = {k: re.findall(r"[^\W_]+", t.lower()) for k, t in texts.items()}
    sets = {k: {tuple(w[i : i + 3]) for i in range(len(w) - 2)} for k, w in words.items()}
    found = near_duplicates(signed_texts(rows, size=3, coordinates=128, count=40, rows=4), 0.6)
    got = [(r.key_a, r.key_b) for r in found.collect()]
    want = _jaccard_pairs(sets, 0.6)
    assert len(got) == len(set(got)) and set(got) <= want and len(want - set(got)) <= 0.02 * len(want)
    assert (1002, 1003) in got and (1004, 1005) in got
    assert near_duplicates(signed_texts(rows.limit(0))).count() == 0
    # sets that are stored give the same as sets that are made again
    stored = near_duplicates(signed_sets(shingle_sets(rows, size=3), 128, 40, 4), 0.6)
    assert {(r.key_a, r.key_b) for r in stored.collect()} == set(got)
    report = {r.key: r for r in classes_and_links(signed_texts(rows, size=3, coordinates=128, count=40, rows=4), 0.6).collect()}
    assert set(report) == {k for k, v in sets.items() if v}
    of_class = {k: min(j for j in sets if sets[j] == sets[k]) for k in report}
    assert {k: r.class_key for k, r in report.items()} == of_class and all(r.copies == sum(of_class[j] == r.class_key for j in report) for r in report.values())
    firsts = set(of_class.values())
    links = Counter(k for pair in set(got) if set(pair) <= firsts for k in pair)
    assert all(r.links == links[r.class_key] for r in report.values())


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 400), min_size=1, max_size=120), st.sets(st.integers(0, 400), max_size=20), st.integers(0, 20), st.sampled_from([0.6, 0.8, 0.95]))
def test_sketches_reject_no_similar_sets(a, more, fewer, threshold):
    b = set(sorted(a)[: max(1, len(a) - fewer)]) | more
    members = np.array([*sorted(a), *sorted(b)], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    own = sketches(members, np.array([len(a), len(b)]))
    if len(a & b) / len(a | b) >= threshold:
        assert may_be_similar(own[:1], own[1:], threshold)[0]


def test_sketches_of_all_sizes(spark):
    lengths = np.array([1, 2, MAPPED, MAPPED + 1, SIZED, SIZED + 1])
    own = sketches(np.arange(lengths.sum(), dtype=np.uint64), lengths)
    assert (own & np.uint64(255)).tolist() == [1, 2, MAPPED, MAPPED + 1, SIZED, 0] and (own[3:] >> np.uint64(8) == 0).all()
    rows = spark.createDataFrame([(int(x), int(y)) for x in own.view(np.int64) for y in own.view(np.int64)], "a long, b long")
    got = [r[0] for r in rows.select(_may_be_similar("a", "b", 0.6)).collect()]
    assert got == [bool(may_be_similar(own[i : i + 1], own[j : j + 1], 0.6)[0]) for i in range(6) for j in range(6)]


def test_hot_bands_take_the_other_way(spark):
    from stockpot.llm.near_duplicates import candidate_pairs

    texts = spark.createDataFrame([(i, " ".join([f"w{j}" for j in range(60)] + [f"x{i}"])) for i in range(30)], "doc_id long, text string")
    sets = shingle_sets(texts, size=3)
    keys = signed_sets(sets, 64, 10, 2).bands
    usual, hot = candidate_pairs(keys, 0.0), candidate_pairs(keys, 0.0, most=3)
    assert {tuple(r) for r in usual.collect()} == {tuple(r) for r in hot.collect()} and usual.count() > 400


def test_near_duplicate_records(spark):
    rows = [(1, "Soup Of Salt", ["salt", "Water ", "egg", "rice", None, " "]), (2, "soup of salt!", ["salt", "water", "egg", "rice"]), (3, "soup of", ["water", "egg", "rice", "salt", "ham"]), (4, None, None), (None, "x", []), (5, "other", ["thing"])]
    records = spark.createDataFrame(rows, "recipe_no long, name string, items array<string>")
    got = {tuple(r) for r in near_duplicates(signed_sets(word_and_item_sets(records, "recipe_no", "name", "items")), 0.8).collect()}
    assert got == {(1, 2), (1, 3), (2, 3)}


TOKENIZER = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no tokenizer file")


@TOKENIZER
def test_token_counts(spark):
    texts = ["Hello  world, naïve 123", "", None, "слово " * 4000]
    rows = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    got = {r.doc_id: r.n_tokens for r in with_token_counts(rows, ["doc_id"]).collect()}
    encode = tokenizer(VOCABULARY).encode_ordinary
    assert got == {i: len(encode(t)) if t else 0 for i, t in enumerate(texts)}
    assert tokenizer(VOCABULARY).decode(encode(texts[0])) == texts[0]


def test_packing_keeps_items_whole(spark):
    rng = np.random.default_rng(1)
    sizes = [int(s) for s in rng.integers(1, 900, 3000)] + [0, 5000, 2048, 2049, None]
    items = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "doc_id long, n_tokens long").repartition(6)
    rows = pack(items, "doc_id", 2048, windows=8).collect()
    fill, by_item = Counter(), {}
    for r in rows:
        fill[r.container] += r.n_tokens
        by_item.setdefault(r.doc_id, []).append((r.piece, r.start, r.n_tokens))
    assert max(fill.values()) <= 2048 and set(by_item) == set(range(len(sizes)))
    for i, s in enumerate(sizes):
        pieces = sorted(by_item[i])
        assert sum(p[2] for p in pieces) == (s or 0) and len(pieces) == max(1, -(-(s or 0) // 2048))
        assert [p[1] for p in pieces] == [2048 * k for k in range(len(pieces))]
    assert sum(fill.values()) / (2048 * len(fill)) > 0.97
    assert pack(items.limit(0), "doc_id").count() == 0


def test_quotas_and_splitting():
    targets = {"a": (0.5, 1), "b": (0.3, 4), "c": (0.2, 1)}
    assert quotas({"a": 1000, "b": 100, "c": 0}, targets) == {"a": 640, "b": 384} or sum(quotas({"a": 1000, "b": 100}, targets).values()) > 0
    q = quotas({"a": 1000, "b": 100}, targets)
    assert abs(q["a"] / sum(q.values()) - 0.625) < 0.01 and q["b"] <= 400
    assert quotas({}, targets) == {}
    counts = np.array([100, 7, 0, 55])
    parts = split_quotas(counts, np.ones(7, np.int64), np.random.Generator(np.random.PCG64(1)))
    wide = split_quotas(counts, np.array([3, 1, 2]), np.random.Generator(np.random.PCG64(1)))
    assert (wide.sum(axis=0) == counts).all() and wide.sum(axis=1).tolist() == [81, 27, 54]
    assert (parts.sum(axis=0) == counts).all() and parts.shape == (7, 4) and parts.sum(axis=1).max() - parts.sum(axis=1).min() <= 1


def test_mixture(spark):
    rng = np.random.default_rng(2)
    rows = [(i, s, int(rng.integers(1, 300))) for i, s in enumerate(["big"] * 2000 + ["mid"] * 500 + ["tiny"] * 60 + ["other"] * 50)]
    items = spark.createDataFrame([*rows, (90000, None, 5), (90001, "big", None), (90002, "big", 0)], "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("big", 0.6, 1), ("mid", 0.2, 2), ("tiny", 0.1, 3), ("absent", 0.1, 4)], "source string, target_share double, max_repeat int")
    mixture = mix(items, targets, shards=5)
    got = mixture.collect()
    uses = Counter(r.doc_id for r in got)
    limit = {"big": 1, "mid": 2, "tiny": 3}
    assert all(uses[r.doc_id] <= limit[r.source] for r in got) and len({(r.doc_id, r.use_no) for r in got}) == len(got)
    assert all([r.pos for r in sorted(got, key=lambda r: r.pos) if r.shard == s] == list(range(1, sum(x.shard == s for x in got) + 1)) for s in range(5))
    report = {r.source: r for r in shares(mixture, items, targets).collect()}
    for source, share in (("big", 0.6), ("mid", 0.2), ("tiny", 0.1)):
        assert abs(report[source].actual_share - share / 0.9) < 0.01
    assert report["absent"].used == 0 and sum(r.actual_share for r in report.values()) == pytest.approx(1)
    assert sorted(map(tuple, mix(items, targets, shards=5).collect())) == sorted(map(tuple, got))
    assert mix(items.limit(0), targets).count() == 0


@pytest.mark.parametrize("broadcast_rows", [0, 10**6])
def test_more_shards_than_the_driver_plans(spark, broadcast_rows):
    # one source has most of the rows, another far more than it may give
    rng = np.random.default_rng(4)
    rows = [(i, s, int(rng.integers(1, 60))) for i, s in enumerate(["big"] * 14000 + ["mid"] * 5000 + ["spare"] * 9000 + ["tiny"] * 40)]
    items = spark.createDataFrame(rows, "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("big", 0.7, 1), ("mid", 0.24, 1), ("spare", 0.05, 3), ("tiny", 0.01, 7)], "source string, target_share double, max_repeat int")
    got = mix(items, targets, shards=300, planned=1_000, broadcast_rows=broadcast_rows).toPandas()
    plain = mix(items, targets, shards=5).toPandas()
    used, before = got.groupby("source")["n_tokens"].sum(), plain.groupby("source")["n_tokens"].sum()
    assert (abs(used - before) <= 60).all() and not got.duplicated(["doc_id", "use_no"]).any()
    fill = got.groupby("shard")["n_tokens"].sum()
    assert len(fill) == 300 and fill.max() < 1.6 * fill.mean() and fill.min() > 0.5 * fill.mean()
    # every shard is a sample of the mixture
    share = got[got.source == "big"].groupby("shard")["n_tokens"].sum() / fill
    assert abs(share.mean() - 0.7) < 0.02 and share.std() < 0.15


def _whole(text):
    change = T._tables()[0]
    text = unicodedata.normalize("NFD", T.LINE_ENDS.sub("\n", text)).translate(change)
    text = unicodedata.normalize("NFD", text).translate(change)
    return unicodedata.normalize("NFC", T._WORD.sub(T._by_script, text))


def test_words_keep_their_script():
    same = ["Москва суп", "ещё один ёжик", "мій борщ", "σούπα ΣΟΥΠΑ", "Coffee и чай"]
    assert [T.canonical(t) for t in same] == same
    mixed = [("Mocквa", "Москва"), ("cуп", "суп"), ("су\u200bп", "суп"), ("cу\u200bп", "суп"), ("е\u0308ж", "ёж"), ("жea", "жеа"), ("жеa\u0301", "же\u0430\u0301"), ("ab\u200bж", "аbж")]
    assert [T.canonical(a) for a, _ in mixed] == [T.canonical(b) for _, b in mixed]
    assert T.canonical("сосоа") == T.canonical("cocoa") == "cocoa" and T.canonical("ко") != T.canonical("kо")


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet=st.sampled_from("aeoAZжσЖ_ ȩ́́̀​­сеоАВÑñ 　ａＺ１ﬁ‑-\n\r\tёйї가각각½²…0O1l"), max_size=40))
def test_segments_equal_the_whole_text(text):
    assert T.canonical(text) == _whole(text) == T.canonical(T.canonical(text))


def test_what_is_visible_stays():
    same = [("Ｆｕｌｌ１", "Full1"), ("café", "café"), ("a​b﻿", "ab"), ("a b", "a b"), ("сосоа", "cocoa"), ("oﬃce", "office"), ("e‑mail", "e-mail"), ("ё", "ë"), ("a\r\nb", "a\nb")]
    assert all(T.canonical(a) == T.canonical(b) for a, b in same)
    differ = [("cafe", "café"), ("a1", "al"), ("O", "0"), ("a", "A"), ("a\nb", "a b"), ("x²", "x2"), ("½", "1/2"), ("n", "ñ")]
    assert all(T.canonical(a) != T.canonical(b) for a, b in differ)


def test_lookalike_pairs(spark):
    rows = [(1, "cocoa"), (2, "сocoa"), (3, "cocoa"), (4, "ｃocoa"), (5, "Cocoa"), (6, None), (7, ""), (8, "​"), (None, "cocoa"), (2, "сocoa"), (9, "x" * 100000), (10, "x" * 99999 + "​x")]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, form string")
    assert {tuple(r) for r in T.lookalike_pairs(docs).collect()} == {(1, 2), (1, 4), (2, 3), (2, 4), (3, 4), (7, 8), (9, 10)}
    assert T.lookalike_pairs(docs.limit(0)).count() == 0
    classes = {r.key: (r.class_key, r.spellings) for r in T.lookalike_classes(docs).collect()}
    assert classes == dict.fromkeys((1, 2, 3, 4), (1, 3)) | {5: (5, 1), 7: (7, 2), 8: (7, 2), 9: (9, 2), 10: (9, 2)}


def test_many_similar_classes_are_joined_by_a_shuffle(spark):
    from stockpot.llm.near_duplicates import similar_classes, spread

    texts = spark.createDataFrame([(i, " ".join([f"w{i // 3}_{j}" for j in range(40)] + [f"x{i}"])) for i in range(30)], "doc_id long, text string")
    signed = signed_texts(texts, size=3, coordinates=128, count=32, rows=4)
    pairs = [{tuple(r) for r in spread(similar_classes(signed, 0.6, broadcast_rows=limit), signed.membership).collect()} for limit in (0, 1000)]
    assert pairs[0] == pairs[1] and len(pairs[0]) == 30
