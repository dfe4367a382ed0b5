"""The text operators on small tables: brute force, nulls, empty and long texts, ties, clashing names."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskloom.llm import (
    chat, components, decontaminate, language, licenses, near_dedup, neighbours, pages, pieces, repeats, sharding,
    words,
)
from riskloom.llm.store import Scratch

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: An extra column of each name that the operators use inside.
CLASH = "doc, key, place, text2, cls, node, n, grp, later, own, changed, mark, source, known, number, part, spot"


def docs_of(spark, texts, clash=True):
    rows = [(d, t, "en", "s", None) for d, t in texts]
    df = spark.createDataFrame(rows, DOCS)
    for name in CLASH.split(", ") if clash else ():
        if name not in df.columns:
            df = df.withColumn(name, F.lit("x"))
    return df


def rand_text(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


HARD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (None, "null id here now ok"), (None, None), (5, "é ü 日本 😀 a b c d e"),
        (5, "é ü 日本 😀 a b c d e"), (6, "!!! ??? 123"), (7, "a b c d"), (8, "A  b\tC d")]


def test_word_codes():
    texts = ["", "Ab  ab x", None, "  ", "ab", "x" * 5000, "ÄB äb"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    seen = {}
    for table, fold, pattern in ((words.NOT_SPACE, words.LOWER, rb"[^\x20\x09-\x0D]+"),
                                 (words.LETTER_DIGIT, words.LOWER, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        for limit in (1, 10, 1 << 20):
            found = []
            for part, raw, offsets in words.chunks(batch, "text", limit):
                w = words.words(raw, offsets, table, fold)
                for r in range(part.num_rows):
                    a, b = w.first[r], w.first[r] + w.count[r]
                    found.append((w.code[a:b].tolist(), list(zip(w.start[a:b], w.end[a:b]))))
            for t, (codes, spans) in zip(texts, found):
                low = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())
                want = [(m[0], m.span()) for m in re.finditer(pattern, low)]
                assert [s for _, s in want] == spans
                for (word, _), code in zip(want, codes):
                    assert seen.setdefault(word, code) == code
    assert len(set(seen.values())) == len(seen)


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1100)]
    root = {v: v for e in links for v in e}
    for _ in range(len(root)):
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
        if not changed:
            break
    df = spark.createDataFrame(links + [(None, 4)], "a long, b long")
    got = {r.vertex: r.root for r in components.components(df, "a", "b", Scratch(spark, "t")).collect()}
    assert all(got.get(v, v) == r for v, r in root.items())


def brute_groups(texts, length, pct):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return frozenset(tuple(w[i:i + length]) for i in range(max(len(w) - length, 0) + 1)) if w else frozenset()
    sets = [shingles(t) for _, t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, j in itertools.combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= pct * (len(sets[i]) + len(sets[j]) - both):
            root[find(i)] = find(j)
    low = {}
    for k, (d, _) in enumerate(texts):
        low[find(k)] = min((x for x in (low.get(find(k)), d) if x is not None), default=None)
    return [(d, len(sets[k]), low[find(k)] if sets[k] else d) for k, (d, _) in enumerate(texts)]


def mutated(rng, text, changes):
    w = text.split()
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"m{rng.randrange(10**6)}"
    return " ".join(w)


def test_near_duplicates_brute_force(spark):
    rng = random.Random(5)
    base = rand_text(rng, 150)
    texts = HARD + [(20, "A b c D"), (9, "long " * 3000), (19, "long " * 2000)]
    family = [base]
    for k in range(90):  # a chain of copies of all similarities, larger than a small node
        family.append(mutated(rng, rng.choice(family), rng.randrange(1, 5)))
        texts.append((100 + k, family[-1]))
    texts += [(300 + k, base + " Same line at the end of many texts " + rand_text(rng, 12)) for k in range(5)]
    texts += [(400 + k, rand_text(rng, 30) + " the very same closing passage of ten words or so here") for k in range(60)]
    rng.shuffle(texts)
    got = near_dedup.near_duplicates(docs_of(spark, texts), shingle=4)
    rows = [tuple(r)[:3] for r in got.collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(rows, key=key) == sorted(brute_groups(texts, 4, 80), key=key)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())


def test_dense_nodes_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    monkeypatch.setattr(near_dedup, "SMALL", 4)
    rng = random.Random(8)
    base = rand_text(rng, 120)
    texts = [(k, mutated(rng, base, rng.randrange(1, 9))) for k in range(60)]
    got = near_dedup.near_duplicates(docs_of(spark, texts), shingle=4)
    assert sorted(tuple(r)[:3] for r in got.collect()) == sorted(brute_groups(texts, 4, 80))


def test_near_duplicates_empty(spark):
    assert near_dedup.near_duplicates(docs_of(spark, [])).collect() == []


def brute_repeats(texts, least):
    places = {}
    for d, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        for i in range(len(w) - least + 1):
            places.setdefault(tuple(w[i:i + least]), set()).add((d, i))
    every, later = {}, {}
    for spots in places.values():
        if len({d for d, _ in spots}) > 1:
            for d, i in spots:
                every.setdefault(d, set()).update(range(i, i + least))
                if (d, i) != min(spots):
                    later.setdefault(d, set()).update(range(i, i + least))
    return every, later


@pytest.mark.parametrize("least, seed", [(50, 16), (12, 4), (6, 6), (5, 1)])
def test_repeated_passages_brute_force(spark, least, seed):
    rng = random.Random(least)
    shared = [rand_text(rng, least + k % 7 - 2) for k in range(14)]
    texts = [(200 + k, " ".join(x for _ in range(4) for x in (rand_text(rng, rng.randrange(1, 40)), rng.choice(shared))))
             for k in range(60)]
    texts += [(100, shared[5] * 2), (101, "a " * 200), (102, "a " * 300)] + [t for t in HARD if t[0] is not None]
    every, later = brute_repeats(dict(texts).items(), least)
    rows = repeats.repeated_passages(docs_of(spark, texts), least, seed).collect()
    spread = lambda spans: {k for a, b in spans for k in range(a, b)}
    assert {r.doc: spread(r.spans) for r in rows} == every
    assert {r.doc: spread(r.later) for r in rows if r.later} == later


def test_without_repeats(spark):
    rng = random.Random(1)
    shared = rand_text(rng, 60)
    texts = [(1, f"start one {shared}\nend"), (2, f" {shared} "), (3, f"é {shared}  über"), (4, "clean text"), *HARD[4:6], (9, "")]
    df = docs_of(spark, texts)
    rows = repeats.without_repeats(df).collect()
    got = [(r.doc_id, r.text) for r in rows]
    assert (1, f"start one {shared}\nend") in got and (3, "é über") in got and (4, "clean text") in got
    assert 2 not in [d for d, _ in got] and (9, "") in got and (None, None) in got
    assert repeats.without_repeats(df).columns == df.columns
    assert repeats.without_repeats(df.limit(0)).collect() == []


def test_without_repeats_of_two_texts_under_one_id(spark):
    rng = random.Random(7)
    shared, clean, other = rand_text(rng, 60), rand_text(rng, 90), rand_text(rng, 55)
    texts = [(1, f"first {shared}"), (2, f"a b {shared} c"), (2, clean), (2, other), (3, f"x {shared}"), (3, f"y {shared}")]
    got = sorted((r.doc_id, r.text) for r in repeats.without_repeats(docs_of(spark, texts)).collect())
    assert got == sorted([(1, f"first {shared}"), (2, "a b c"), (2, clean), (2, other), (3, "x "), (3, "y ")])
    spots = repeats.repeated_passages(docs_of(spark, texts)).collect()
    assert sorted(r.doc for r in spots) == [1, 2, 3]
    both = [(5, f"m n {shared}"), (5, f"o p {shared}"), (6, f"z {shared}")]
    left = [r.text for r in repeats.without_repeats(docs_of(spark, both)).collect() if shared in r.text]
    assert len(left) == 1


def brute_contaminated(texts, items, window):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    split = lambda t: re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = []
    for d, t in texts:
        w, hit, found = split(t), set(), set()
        for i, x in items:
            v = split(x)
            n = min(len(v), window)
            for at in range(len(v) - n + 1 if v else 0):
                for p in range(len(w) - n + 1):
                    if w[p:p + n] == v[at:at + n]:
                        hit.update(range(p, p + n))
                        found.add(str(i))
        out.append((d, len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("item_words", [1 << 20, 60])
def test_contaminated_brute_force(spark, monkeypatch, item_words):
    monkeypatch.setattr(decontaminate, "ITEM_WORDS", item_words)
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 300)
    rng = random.Random(2)
    items = [(k, rand_text(rng, rng.randrange(1, 40), 60)) for k in range(12)] + [(50, None), (51, ""), (52, "W1, w2!"), (53, "w1 w2")]
    texts = HARD + [(100 + k, rand_text(rng, 60, 60) + " " + " ".join(items[k % 12][1].split()[k % 3:]).upper())
                    for k in range(25)]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = decontaminate.contaminated(docs_of(spark, texts), table)
    key = lambda r: (r[0] is None, r)
    rows = [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got.collect()]
    want = brute_contaminated(texts, items, 13)
    assert sorted(rows, key=lambda r: str(key(r))) == sorted(want, key=lambda r: str(key(r)))


def test_near_matches_and_empty_tables(spark):
    texts = [(1, "x one two three MORE four five y"), (2, "one two three four five"), (3, "five four three two one"),
             (4, "one two three a b c d e f g h four five")]
    items = spark.createDataFrame([(7, "one two three four five")], "item_id long, text string")
    rows = {r.doc_id: r for r in decontaminate.contaminated(docs_of(spark, texts), items, slop=2).collect()}
    assert [rows[k]["near_items"] for k in (1, 2, 3, 4)] == [["7"], ["7"], [], []]
    assert [rows[k]["items"] for k in (1, 2, 3, 4)] == [[], ["7"], [], []]
    assert decontaminate.contaminated(docs_of(spark, []), items).collect() == []
    none = decontaminate.contaminated(docs_of(spark, texts), items.limit(0)).collect()
    assert [r.n_hit for r in none] == [0] * 4
    left = decontaminate.without(docs_of(spark, texts), decontaminate.contaminated(docs_of(spark, texts), items).where("n_hit > 0"))
    assert sorted(r.doc_id for r in left.collect()) == [1, 3, 4]


def test_pieces(spark):
    texts = HARD + [(10, "a" * 3000 + " b"), (11, "x\r\n\ty   <s></s> <0x0A> ▁ z")]
    df = docs_of(spark, texts).withColumn("ids", F.lit("gone"))
    out = pieces.encode(df, "text", "ids", round_trip="round_trip")
    assert out.columns == [*[c for c in df.columns if c != "ids"], "ids", "round_trip"]
    rows = out.collect()
    assert len(rows) == len(texts) and all(r.round_trip for r in rows)
    assert all((r.ids is None) == (r.text is None) for r in rows)
    back = pieces.decode(out.withColumnRenamed("text", "before"), "ids", "text").collect()
    assert all(r.text == (None if r.before is None else r.before.replace("▁", " ")) for r in back)
    assert pieces.encode(df.limit(0)).collect() == []


def test_pieces_of_very_long_runs():
    import resource
    rng = random.Random(8)
    encoder = pieces.Encoder(pieces.Model(open(pieces.MODEL, "rb").read()))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    for letters in ("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", "日本語の文章です龘靐"):
        text = "".join(rng.choice(letters) for _ in range(200_000))
        ids = np.frombuffer(encoder.encode([text])[0], np.int32)
        assert pieces.decoded(encoder.model, ids) == text
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500_000    # KB


def test_unigram_segmentation_is_the_best_one():
    rng = random.Random(4)

    def message(*fields):
        out = b""
        for number, value in fields:
            if isinstance(value, int):
                out += bytes([number << 3, value])
            elif isinstance(value, float):
                import struct
                out += bytes([number << 3 | 5]) + struct.pack("<f", value)
            else:
                size, head = len(value), b""
                while size > 127:
                    head, size = head + bytes([size & 127 | 128]), size >> 7
                out += bytes([number << 3 | 2]) + head + bytes([size]) + value
        return out
    made = {"▁"} | {"a", "b", "c", "▁a"} | {"".join(rng.choice("abc") for _ in range(rng.randrange(2, 5))) for _ in range(30)}
    scores = {p: round(-rng.random() * 9 - 1, 3) for p in sorted(made)}
    data = message((1, message((1, b"<unk>"), (3, 2))))
    data += b"".join(message((1, message((1, p.encode()), (2, s)))) for p, s in scores.items())
    model = pieces.Model(data + message((2, message((3, 1)))) + message((3, message((3, 1), (4, 0)))))
    encoder = pieces.Encoder(model)

    def best(word):
        if not word:
            return 0.0
        return max(scores[word[:k]] + best(word[k:]) for k in range(1, len(word) + 1) if word[:k] in scores)
    for _ in range(60):
        text = " ".join("".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))) for _ in range(3))
        ids = np.frombuffer(encoder.encode([text])[0], np.int32)
        total = sum(model.scores[i] for i in ids)
        assert total == pytest.approx(sum(best("▁" + w) for w in text.split()), abs=1e-4)
        assert pieces.decoded(model, ids) == text


def test_language_edges(spark):
    rng = random.Random(6)
    make = {"aa": "abcde", "bb": "vwxyz"}
    rows = [(k, "".join(rng.choice(make[g] + " ") for _ in range(200)), g, "s", 0) for k in range(60) for g in [rng.choice(["aa", "bb"])]]
    rows += [(100, None, "aa", "s", 0), (101, "", "bb", "s", 0), (102, "12 !?", "aa", "s", 0), (None, "abc abc", "aa", "s", 0),
             (103, "xyz " * 50000, None, "s", 0), (104, "日本", "aa", "s", 0)]
    found = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, DOCS).withColumn("known", F.lit(1))).collect()}
    assert len(found) == len(rows)
    assert all(found[d].lang_pred == g for d, t, g, _, _ in rows[:60])
    assert [found[d].lang_pred for d in (100, 101, 102)] == ["und"] * 3 and found[100].score == 0
    assert found[103].lang_pred == "bb" and found[None].lang_pred == "aa" and not found[None].held_out
    none = language.identify(spark.createDataFrame(rows[:3], DOCS).withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert language.identify(spark.createDataFrame([], DOCS)).collect() == []


def test_chat_edges(spark):
    schema = "conv_id long, turn long, role string, text string"
    text = "</s>[INST] &lt; &amp; [/INST]\n"
    rows = [(1, 1, "assistant", text), (1, 0, "user", None), (1, 1, "assistant", text), (2, 5, None, ""), (None, 0, "user", "n"),
            (3, None, "a\nb</s>", "z"), *[(4, k, "user" if k % 2 else "assistant", f"é{k}") for k in range(70)]]
    df = spark.createDataFrame(rows, schema).withColumn("depth", F.lit(1)).withColumn("tree", F.lit(2))
    out = chat.conversations(chat.turns(df)).select(
        "tree", "formatted", chat.read_turns(F.col("formatted")).alias("t"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("said"))
    got = {r.tree: r for r in out.collect()}
    assert len(got) == 5
    assert [tuple(x) for x in got[1].t] == [("user", ""), ("assistant", text), ("assistant", text)] and got[1].said == text * 2
    assert [tuple(x) for x in got[2].t] == [("", "")] and [tuple(x) for x in got[3].t] == [("a\nb</s>", "z")]
    assert [x.text for x in got[4].t] == [f"é{k}" for k in range(70)] and got[4].said == "".join(f"é{k}" for k in range(0, 70, 2))
    assert got[1].formatted.count(chat.CLOSE) == 3
    assert chat.conversations(chat.turns(df.limit(0))).collect() == []


def test_reply_trees(spark):
    rng = random.Random(9)
    rows, parents = [], {}
    for tree in (1, 2, None):
        for node in range(80):
            parent = None if node == 0 else rng.choice([None] * (node % 30 == 0) + [rng.randrange(max(0, node - 4), node)])
            parents[tree, node] = (parent, rng.randrange(5))
            rows.append((tree, node, parent, "user", f"{tree}/{node}", float(parents[tree, node][1])))
    rows += [(5, 1, 2, "user", "cycle", 1.0), (5, 2, 1, "user", "cycle", 1.0), (6, 1, 77, "assistant", "orphan", None)]
    df = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    got = {}
    for r in chat.conversations(df, best=3).select("tree", "leaf", chat.read_turns(F.col("formatted")).alias("t")).collect():
        got.setdefault(r.tree, []).append((r.leaf, [x.text for x in r.t]))
    for tree in (1, 2, None):
        inner = {p for (t, _), (p, _) in parents.items() if t == tree}
        paths = []
        for leaf in (n for t, n in parents if t == tree and n not in inner):
            path, at = [], leaf
            while at is not None:
                path.append(at)
                at = parents[tree, at][0]
            paths.append((-sum(parents[tree, n][1] for n in path), leaf, [f"{tree}/{n}" for n in path[::-1]]))
        assert sorted(got[tree]) == sorted((leaf, path) for _, leaf, path in sorted(paths)[:3])
    assert got[6] == [(1, ["orphan"])] and 5 not in got


def test_nearest_edges(spark):
    rng = np.random.default_rng(1)
    rows = [(k, rng.normal(size=70).round(3).tolist()) for k in range(300)]
    hot = rng.normal(size=70).round(3).tolist()
    rows += [(1000 + k, hot) for k in range(120)] + [rows[0], (2000, None), (2001, [0.0] * 70), (2002, [float("nan")] * 70),
             (2003, [None] + [1.0] * 69), (2004, [1.0]), (None, hot), (2005, [float("inf")] + [1.0] * 69)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"v": F.lit(1), "row": F.lit(2), "block": F.lit(1)})
    got = neighbours.nearest(df, F.pmod("vec_id", F.lit(20)) == 0, k=20).collect()
    ids = np.array([r[0] for r in rows[:420]])
    vectors = np.array([r[1] for r in rows[:420]])
    hits = total = 0
    for q in ids[ids % 20 == 0].tolist():
        scores = (vectors * vectors[ids == q][0]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:20]
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert len(mine) == 20
        if q >= 1000:  # the hot vector: all ties, smallest ids first
            assert [r.vec_id for r in mine] == ids[order].tolist()
        hits += len({r.vec_id for r in mine} & set(ids[order].tolist()))
        total += 20
    assert hits >= 0.95 * total
    assert {r.query_id for r in got} == set(ids[ids % 20 == 0].tolist())
    few = neighbours.nearest(df.where("vec_id < 3"), F.col("vec_id") == 0).collect()
    assert [r["rank"] for r in few] == [1, 2]
    assert neighbours.nearest(df.limit(0), F.col("vec_id") == 0).collect() == []


@pytest.mark.parametrize("rows", [1, 2, 3, 5, 17, 256, 1000])
def test_permutation(rows):
    places = sharding.permuted(np.arange(rows), rows)
    assert sorted(places.tolist()) == list(range(rows))
    assert sharding.original(places, rows).tolist() == list(range(rows))


def test_shards_do_not_depend_on_partitions(spark):
    texts = HARD + [(k, f"t{k}") for k in range(50)]
    df = docs_of(spark, texts).withColumn("shard", F.lit("old"))
    order = ["doc_id", "text"]
    one = sharding.shards(df.repartition(1), order, 3).collect()
    two = sharding.shards(df.repartition(7), order, 3).collect()
    key = lambda r: str((r.doc_id, r.text, r.shard, r.slot))
    assert sorted(map(key, one)) == sorted(map(key, two))
    assert sorted((r.slot * 3 + r.shard for r in one)) == list(range(len(texts)))
    assert sharding.shards(df.limit(0), order, 3).collect() == []


def test_licenses(spark):
    mit = licenses.TEMPLATES["mit-permission"]
    w = mit.split()
    texts = HARD + [(20, f"x y\n# {mit.upper()} end"), (21, " ".join(w[:20])), (22, "Released under  the\tMIT-License"),
                    (23, " ".join(["pad"] * 500) + " Licensed under CC BY-NC 4.0." + " pad" * 20000), (24, "released under the mit"),
                    (25, " ".join(w[:30] + ["changed"] + w[31:])), (25, " ".join(w[:30] + ["changed"] + w[31:]))]
    got = {(r.doc_id, r.template): r for r in licenses.find(docs_of(spark, texts)).collect()}
    assert set(got) == {(20, "mit-permission"), (22, "mit"), (23, "cc-by-nc-4.0"), (25, "mit-permission")}
    assert got[20, "mit-permission"].containment == 1 and 0.8 <= got[25, "mit-permission"].containment < 1
    assert licenses.find(docs_of(spark, [])).collect() == []
    assert licenses.find(docs_of(spark, texts), {}).collect() == []


def test_page_reading():
    def read(page, keep=lambda t: True):
        tree = pages.Tree(page)
        return tree.text(np.ones(len(tree.parent), bool))
    assert read("") == "" and read("plain &amp; simple") == "plain & simple"
    assert read("<p>a<p>b <b>c</b>d<br>e</p>f") == "a\n\nb cd e\n\nf"
    assert read("<script>var a='<p>x</p>'</script><style>p{}</style><p>t<!-- c --></p>") == "t"
    assert read("<ul><li>1<li>2</ul><table><tr><td>x<td>y</table>") == "1\n\n2\n\nx\n\ny"
    assert read('<div title="a > b">q</div><p class=x>\n r\n s </p><broken') == "q\n\nr s"
    assert read("<p>" * 3000 + "deep") == "deep" and read("<div>" * 3000 + "deep") == "deep"


def test_scripts_and_open_heads_do_not_take_the_page():
    def read(page):
        tree = pages.Tree(page)
        return tree.text(np.ones(len(tree.parent), bool))
    assert read("<script>for(i=0;i<n;i++){x()}</script><article>a</article>") == "a"
    assert read("<script><!-- if(a<b) x='</b>'</SCRIPT ><p>a</p><script>y</script>") == "a"
    assert read("<style>a<b{}</style x><p>a</p><textarea><!-- </textarea>b") == "a\n\nb"
    assert read("<head><title>T <p> x</title><meta a=b><script>i<n</script><body><p>a</p>") == "a"
    assert read("<html><head><title>T</title><link><p>a</p>") == "a"
    assert read("<head><style>x</style>a <b>b</b>") == "a b" and read("<head> <title>T</title> </head>a") == "a"
    assert read("<head><base></title><title>T</title></body>a") == "a" and read("<p>a</p><script>x<p>b</p>") == "a"


def test_pages_edges(spark):
    rows = [(1, "u", None), (2, "u", ""), (3, "u", "<html>"), (4, None, "<article><p>" + "word " * 60000 + "</article><footer>f</footer>"),
            (4, None, "<nav><a>m</a></nav><article><h1>T</h1><p>One sentence, here.</p></article><div class=comments><p>No, not me.</div>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("old")).withColumn("source", F.lit(1))
    got = pages.main_text(df)
    assert got.columns == ["page_id", "url", "html", "source", "text"]
    found = [r.text for r in got.collect()]
    assert sorted(found)[:3] == ["", "", ""] and "T\n\nOne sentence, here." in found and ("word " * 60000).strip() in found
    assert pages.main_text(df.limit(0)).collect() == []


def test_decoding_is_the_best_consistent_choice():
    rng = np.random.default_rng(3)
    for _ in range(50):
        n = int(rng.integers(1, 9))
        parent = [-1] + [int(rng.integers(0, k)) for k in range(1, n)]
        odds = rng.normal(size=n)
        best = max((s for s in itertools.product([0, 1], repeat=n)
                    if all(not s[k] or s[parent[k]] for k in range(1, n))),
                   key=lambda s: sum(o if x else -o for o, x in zip(odds, s)))
        assert pages.decode(parent, odds).astype(int).tolist() == list(best)


def test_short_heads_of_clean_texts_are_not_refused(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(docs.select("doc_id", "text", "lang").where(language.fold() != 0), checked=language.CHECKED)
    held = docs.where(language.fold() == 0).where("lang IS NOT NULL")
    heads = held.select(F.explode(F.array(*[F.substring("text", 1, n) for n in (8, 12, 20, 30, 50)])).alias("text"))
    refused = language.annotate(heads, model, "l", "s", refused="r").where("r").count()
    assert refused <= 0.03 * heads.count()
    rng = random.Random(4)
    junk = [("".join(rng.choice(a) for _ in range(n)),) for n in (40, 120, 400) for _ in range(30)
            for a in ("абвгдежзиклмнопрст", "中文字漢語日本国人", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")]
    kept = language.annotate(spark.createDataFrame(junk, "text string"), model, "l", "s", refused="r").where("NOT r").count()
    assert kept <= 0.05 * len(junk)
