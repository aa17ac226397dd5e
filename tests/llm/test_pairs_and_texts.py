"""Operators on documents against brute force, and on awkward rows."""

import random
import re

import numpy as np
import pytest

from caselake.llm import decontamination, substrings
from caselake.llm import near_duplicates as near
from caselake.llm.decontamination import drop_leaking, find_leaks
from caselake.llm.near_duplicates import _links_within, _sketch, components, drop_near_duplicates, near_duplicates
from caselake.llm.substrings import drop_repeats
from caselake.llm.words import LETTERS, Words, grams, slices

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def frame(spark, rows, schema="doc_id bigint, text string"):
    return spark.createDataFrame(rows, schema)


def corpus(seed, n=60):
    """Texts with copies, near copies, shared passages, odd spaces, empty and very long ones."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Été", "ß", "naïve"]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    texts = [None, "", " \t\n", "one", "One", "two words", "x " * 500]
    for _ in range(n):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(5, 120))]
        kind = rng.random()
        if kind < 0.3 and texts[-1]:
            base = words(texts[-1])
            for _ in range(rng.randint(0, 3)):
                base[rng.randrange(len(base))] = "edit"
        elif kind < 0.5:
            at = rng.randrange(len(base))
            base[at:at] = passage[rng.randint(0, 20) : rng.randint(40, 60)]
        texts.append(rng.choice([" ", "\n", " \t"]).join(base))
    texts += [texts[9], texts[9], " ".join(rng.choice(vocabulary) for _ in range(30_000))]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts))


def jaccard_components(rows, k, percent):
    def shingles(t):
        w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())

    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                s = len(sets[a] & sets[b])
                if 100 * s >= percent * (len(sets[a]) + len(sets[b]) - s):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_words_are_those_of_the_pattern():
    import pyarrow as pa

    texts = [t for _, t in corpus(5)]
    column = pa.array(texts)
    got = []
    for s, e in slices(column, 2000):
        w = Words(column.slice(s, e - s))
        flat = [w.text[a:b].tobytes().decode() for a, b in zip(w.start, w.end)]
        got += [flat[w.first[i] : w.first[i + 1]] for i in range(e - s)]
    assert got == [words(t) for t in texts]
    w = Words(pa.array(["ÀB c1!d", "ab"]), lower=True, classes=LETTERS)
    assert [w.data[a:b].tobytes().decode() for a, b in zip(w.start, w.end)] == ["àb", "c1", "d", "ab"]
    a, b = Words(pa.array(["x y z y z"])), Words(pa.array(["q y z"]))
    assert grams(a.hashes(), 2)[1] == grams(a.hashes(), 2)[3] == grams(b.hashes(), 2)[1] != grams(a.hashes(), 2)[0]


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(0)
    universe = rng.integers(0, 2**63, 300).astype(np.uint64)
    sets = [universe[:1], universe[:200], universe[100:300], universe[:250]]
    row = np.repeat(np.arange(4), [len(s) for s in sets])
    sketch = _sketch(row, np.concatenate(sets), 4, 336)
    assert (sketch != np.uint64(2**64 - 1)).all()
    for a, b in ((1, 2), (1, 3)):
        true = len(set(sets[a].tolist()) & set(sets[b].tolist())) / len(set(sets[a].tolist()) | set(sets[b].tolist()))
        assert abs((sketch[a] == sketch[b]).mean() - true) < 0.12


@pytest.mark.parametrize(("k", "seed"), [(2, 1), (5, 2)])
def test_near_duplicates_equal_brute_force(spark, k, seed):
    rows = corpus(seed)
    got = {r.id: (r.n_shingles, r.component) for r in near_duplicates(frame(spark, rows), shingle=k).collect()}
    assert got == jaccard_components(rows, k, 80)


def test_many_near_copies_of_each_other(spark):
    rng = random.Random(9)
    base = [f"t{i}" for i in range(100)]
    rows = [(i, " ".join(w if rng.random() > 0.06 else f"r{rng.random()}" for w in base)) for i in range(80)]
    got = {r.id: (r.n_shingles, r.component) for r in near_duplicates(frame(spark, rows), shingle=2).collect()}
    assert got == jaccard_components(rows, 2, 80)


def test_links_in_blocks_are_those_of_all_pairs():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, 50)) for _ in range(40)]
    ids, side = np.arange(40, dtype=np.int64), np.arange(40) % 2
    a, b = _links_within(sets, ids, ids, side, 50)
    assert set(zip(a.tolist(), b.tolist())) and all(x > y for x, y in zip(a, b))
    assert len(_links_within(sets, ids, np.zeros(40, np.int64), None, 1)[0]) == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(30)] + [(100, 102), (101, 102), (7, 7)]
    got = {r.id: r.component for r in components(frame(spark, chain, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(31)} | {100: 100, 101: 100, 102: 100}
    assert components(frame(spark, [], "a bigint, b bigint")).count() == 0


def test_near_duplicates_of_awkward_rows(spark):
    long = " ".join(f"v{i}" for i in range(50))
    rows = [(None, long, "a"), (2, long, "b"), (1, long.upper(), "c"), (3, None, "d"), (4, "", "e"), (5, "", "f"), (2, long, "g")]
    df = frame(spark, rows, "doc_id bigint, text string, component string")
    got = sorted(((r.id, r.n_shingles, r.component) for r in near_duplicates(df).collect()), key=str)
    assert got == sorted([(None, 46, None), (2, 46, 1), (2, 46, 1), (1, 46, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5)], key=str)
    assert sorted(r.component for r in drop_near_duplicates(df).collect()) == ["a", "c", "d", "e", "f"]
    assert near_duplicates(df.limit(0)).count() == 0 and drop_near_duplicates(df.limit(0)).columns == df.columns


def brute_repeats(rows, n=13):
    first = {}
    for i, t in rows:
        w = words(t)
        for j in range(len(w) - n + 1):
            key = tuple(w[j : j + n])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, t in rows:
        w = words(t)
        gone = set()
        for j in range(len(w) - n + 1):
            if first[tuple(w[j : j + n])] < i:
                gone |= set(range(j, j + n))
        out[i] = (" ".join(x for k, x in enumerate(w) if k not in gone), len(w), len(gone))
    return out


@pytest.mark.parametrize("seed", [3, 4])
def test_repeats_equal_brute_force(spark, seed):
    rows = corpus(seed)
    got = {r.doc_id: (r.text, r.n_words, r.n_removed) for r in drop_repeats(frame(spark, rows)).collect()}
    assert got == brute_repeats(rows)


def test_repeats_of_awkward_rows(spark):
    long = " ".join(f"v{i}" for i in range(40))
    rows = [(None, long, 1), (5, long, 2), (3, "x " + long + " y", 3), (9, "a " * 60, 4), (8, "a " * 30, 5), (7, None, 6)]
    df = frame(spark, rows, "doc_id bigint, text string, n_words int")
    got = {r.doc_id: (r.text, r.n_words, r.n_removed) for r in drop_repeats(df).collect()}
    assert got[None] == (long, 40, 0) and got[5] == ("", 40, 40) and got[3][2] == 0 and got[7] == ("", 0, 0)
    assert got[8][2] == 0 and got[9] == ("", 60, 60)
    assert drop_repeats(df.limit(0)).count() == 0


def folded(text):
    return re.findall(r"[^\W_]+", "".join(c.lower() if "A" <= c <= "Z" or "À" <= c <= "Þ" else c for c in text or ""))


def brute_leaks(docs, items, k=5, threshold=0.8):
    from collections import Counter
    from math import log

    def shingles(w):
        return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else Counter([tuple(w)] if w else [])

    known = {i: folded(t) for i, t in items if i is not None and folded(t)}
    sets = {i: shingles(w) for i, w in known.items()}
    df = Counter(s for c in sets.values() for s in c)
    weight = lambda s: log(1 + len(sets) / df[s]) if s in df else log(1 + len(sets))
    out = set()
    for d, t in docs:
        w = folded(t)
        for i, words_ in known.items():
            n = min(len(words_), len(w))
            for j in range(len(w) - n + 1 if n else 0):
                c = shingles(w[j : j + n])
                both = sum(min(c[s], sets[i][s]) * weight(s) for s in c)
                whole = sum(x * weight(s) for s, x in c.items()) + sum(x * weight(s) for s, x in sets[i].items()) - both
                if both >= (threshold - 1e-9) * whole:
                    out.add((d, i))
    return out


def test_leaks_equal_brute_force(spark):
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(80)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 40)))) for i in range(15)] + [(20, "short one"), (21, ""), (22, None), (None, "w1 w2 w3 w4 w5 w6")]
    docs = [(0, None), (1, ""), (2, "short one"), (3, "a short one b")]
    for d in range(4, 60):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(1, 80))]
        if d % 2:
            passage = (items[rng.randrange(15)][1] or "").split()
            for _ in range(rng.choice([0, 0, 1, 3])):
                passage[rng.randrange(len(passage))] = "changed"
            at = rng.randrange(len(w))
            w[at:at] = passage
        docs.append((d, " ".join(x.upper() if rng.random() < 0.2 else x + rng.choice(["", ",", "."]) for x in w)))
    found = find_leaks(frame(spark, docs), frame(spark, items, "item_id bigint, text string"))
    got = {(r.doc_id, x.item_id) for r in found.collect() for x in r.leaks}
    assert got == brute_leaks(docs, items)
    several = find_leaks(frame(spark, docs), frame(spark, items, "item_id bigint, text string"), index_chars=400)
    assert {(r.doc_id, x.item_id) for r in several.collect() for x in r.leaks} >= {(d, i) for d, i in got if i < 15}
    clean = drop_leaking(frame(spark, docs), frame(spark, items, "item_id bigint, text string"))
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in got}


def test_leaks_do_not_depend_on_the_number_of_indexes(spark):
    rng = random.Random(13)
    draw = lambda n: [f"w{rng.randrange(80)}" for _ in range(n)]
    shared = [draw(20) for _ in range(3)]
    items = [(i, " ".join(draw(rng.randint(0, 25)) + shared[i % 3] * (i % 4 > 0) + draw(rng.randint(0, 12)))) for i in range(40)] + [(50, "two words"), (51, "two words"), (52, "")]
    docs = [(0, "so two words here")]
    for d in range(1, 120):
        w = items[rng.randrange(40)][1].split()
        for _ in range(rng.randint(0, 2)):
            w = [x if rng.random() > 0.015 else "changed" for x in w]
        docs.append((d, " ".join(draw(rng.randint(0, 9)) + w + draw(rng.randint(0, 9)))))
    benchmark = frame(spark, items, "item_id bigint, text string")
    found = [{(r.doc_id, *x) for r in find_leaks(frame(spark, docs), benchmark, **size).collect() for x in r.leaks} for size in ({}, {"index_chars": 400})]
    assert found[0] == found[1]
    assert {x[:2] for x in found[1]} == brute_leaks(docs, items)


def test_leaks_of_awkward_rows(spark):
    docs = frame(spark, [(None, "a b c d e f g", "kept")], "doc_id bigint, text string, leaks string")
    none = frame(spark, [], "item_id bigint, text string")
    assert drop_leaking(docs, none).collect()[0].leaks == "kept"
    same = frame(spark, [(1, "A b, c d e f g."), (2, "a b c d e f g")], "item_id bigint, text string")
    assert [x.item_id for x in find_leaks(docs, same).collect()[0].leaks] == [1, 2]
    assert find_leaks(docs.limit(0), same).count() == 0


def test_blocks_hold_every_pair_of_different_components(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 2)
    buckets = {7: {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 8: 8, 9: 8, 10: 10}, 8: {2: 1, 4: 1, 6: 1, 9: 8}, 1: {8: 8, 9: 8, 10: 10}}
    main = {7: 1, 8: 1, 1: 8}
    rows = [(key, i, c, main[key], sum(x != main[key] for x in of.values())) for key, of in buckets.items() for i, c in of.items()]
    split = spark.createDataFrame(rows, "key long, id long, c long, main long, rest long")
    groups: dict[tuple, list] = {}
    for r in near._rest_blocks(split).unionByName(near._main_blocks(split)).collect():
        groups.setdefault((r["key"], r["i"], r["j"]), []).append(r)
    held = {tuple(sorted((x["id"], y["id"]))) for (_, i, j), of in groups.items() for x in of for y in of if x["c"] != y["c"] and (i == j or x["block"] != y["block"])}
    wanted = {tuple(sorted((x, y))) for of in buckets.values() for x in of for y in of if of[x] != of[y]}
    assert wanted <= held


def test_blocks_list_every_item_within_the_radius():
    rng = np.random.default_rng(8)
    items = decontamination._Items(list(range(300)), [" ".join(f"w{x}" for x in rng.integers(0, 50, 12)) for _ in range(300)], 5, 0.8, 22)
    prints = np.concatenate((items.print[:50] ^ np.packbits(rng.random((50, 64)) < 0.25, axis=1), rng.integers(0, 256, (50, 8)).astype(np.uint8)))
    distance = np.unpackbits(prints[:, None, :] ^ items.print[None, :, :], axis=2).sum(2)
    listed = np.zeros((100, 300), bool)
    for b, (held, first) in enumerate(items.blocks[12]):
        for i, v in enumerate(prints[:, b]):
            listed[i, held[first[v] : first[int(v) + 1]]] = True
    assert ((distance <= 22) <= listed).all() and not listed.all()


def test_leaks_in_a_very_long_text_with_common_phrases(spark, monkeypatch):
    phrase = "one two three four five six seven"
    items = [(i, f"{phrase} item {i} has some more words {i}") for i in range(200)]
    long = " ".join([phrase, "and then"] * 6000) + " " + items[17][1] + " end"
    found = find_leaks(frame(spark, [(1, long), (2, items[3][1].upper())]), frame(spark, items, "item_id bigint, text string"))
    got = {r.doc_id: {x.item_id for x in r.leaks} for r in found.collect()}
    assert 17 in got[1] and 3 in got[2]
    plain = decontamination._matches(__import__("pyarrow").array([long[-300:]]), decontamination._index(items, 5, 0.8, 22))
    monkeypatch.setattr(decontamination, "STEP", 50)
    small = decontamination._matches(__import__("pyarrow").array([long[-300:]]), decontamination._index(items, 5, 0.8, 22))
    assert all((a == b).all() for a, b in zip(plain, small)) and 17 in plain[1]


def test_documents_keep_columns_of_any_name(spark):
    names = ["leaks", "_leaks", "id", "component", "_h"]
    docs = spark.createDataFrame([(1, "a b c d e f g", *names), (2, "other words", *names)], "doc_id bigint, text string, leaks string, _leaks string, id string, component string, _h string")
    kept = drop_leaking(docs, frame(spark, [(1, "a b c d e f g"), (2, "q r s t u v")], "item_id bigint, text string"), index_chars=10)
    assert kept.columns == docs.columns and [tuple(r)[2:] for r in kept.collect()] == [tuple(names)]


def plain_paths(edges):
    """Of (source, place, tail, head): the maximal runs of places of a source joined by nodes with one edge in and one out."""
    out, into = {}, {}
    for e in edges:
        out.setdefault(e[2], []).append(e)
        into.setdefault(e[3], []).append(e)
    at = {(e[0], e[1]): e for e in edges}
    goes_on = lambda e, f: f is not None and e[3] == f[2] and len(out[f[2]]) == len(into[f[2]]) == 1
    path = {}
    for e in sorted(edges):
        before = at.get((e[0], e[1] - 1))
        path[e[0], e[1]] = path[e[0], e[1] - 1] if before and goes_on(before, e) else e[1]
    return path


def test_paths_are_the_nonbranching_runs(spark):
    rng = random.Random(17)
    edges = [(1, p, p, p + 1) for p in range(30, 900)]  # one long path, but for what follows
    edges += [(2, 5, 100, 5000), (2, 6, 5000, 5001), (3, 0, 6000, 400)]  # a way out at node 100, a way into node 400
    edges += [(4, p, 10_000 + p, 10_001 + p) for p in range(300) if rng.random() < 0.9]
    edges += [(5, 63, 20_000, 20_001), (5, 64, 20_001, 20_002), (6, 64, 20_500, 20_501), (7, 10, 30_000, 30_000)]
    found = substrings._paths(spark.createDataFrame(edges, "source_id bigint, source_place int, tail bigint, head bigint")).collect()
    got = {(r.source_id, p): r.path for r in found for p in range(r.low, r.high + 1)}
    assert got == plain_paths(edges) and len(set(got.items())) == len(edges)
    assert {got[1, p] for p in range(30, 900)} == {30, 100, 400}
    assert substrings._paths(spark.createDataFrame([], "source_id bigint, source_place int, tail bigint, head bigint")).count() == 0


def test_repeats_with_gaps_repeated_ids_and_columns_of_any_name(spark):
    rng = random.Random(5)
    base = [f"v{i}" for i in range(300)]
    broken = list(base)
    broken[60], broken[61], broken[200] = "x", "y", "z"
    rows = [(1, " ".join(base)), (2, " ".join(broken)), (3, " ".join(base[100:] + base[:90])), (4, " ".join(base[40:80])), (4, " ".join(base[40:70])), (5, " ".join(rng.choice(base) for _ in range(50)))]
    rows += [(i, " ".join(base[20:60])) for i in range(10, 40)]
    names = ["_copy", "copy", "_spans", "spans", "_cut", "cut"]
    df = spark.createDataFrame([(*r, *names) for r in rows], "doc_id bigint, text string, " + ", ".join(f"{c} string" for c in names))
    out = drop_repeats(df)
    assert out.columns == [*df.columns, "n_words", "n_removed"]
    got = {}
    for r in out.collect():
        assert [r[c] for c in names] == names
        got.setdefault(r.doc_id, set()).add((r.text, r.n_words, r.n_removed))
    one = {i: t for i, t in rows if i != 4}
    want = {i: {x} for i, x in brute_repeats(list(one.items())).items()}
    assert {i: x for i, x in got.items() if i != 4} == want
    assert got[4] == {("", 40, 40), ("", 30, 30)}


@pytest.mark.parametrize("operator", ["op1_preference", "op2_near_duplicates", "op8_substrings"])
def test_queries_equal_their_sql(spark, operator):
    import duckdb

    from caselake.llm import queries

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    df = queries.queries()[operator](spark, folder)
    want = con.execute(queries.oracle_sql()[operator])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(str, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(str, want.fetchall()))
