"""Corpus operators against brute force, round trips and the edge cases their docstrings define."""

import io
import random

import duckdb
import numpy as np
import pandas as pd
import pytest

pytest.importorskip("eventloom.llm")
from eventloom.llm import common, decontamination, host_rules, html, jaccard, packing, quality, queries, shingles, substring, tokens, toxicity, warc  # noqa: E402

DATA = "/root/testdata/sf0.001"
EDGES = [(1, None), (2, ""), (3, "a b c d e f g h i j k"), (3, "a b c d e f g h i j k"), (4, "word " * 20000), (None, "x y")]


def edge_docs(spark):
    return spark.createDataFrame([(i, t, "en", "s", 1, "clash") for i, t in EDGES], "doc_id long, text string, lang string, source string, n_chars long, tok string")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for t in "documents pages benchmark labels".split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got, want = queries.queries()[name](spark, DATA).toPandas(), con.sql(queries.oracle_sql()[name]).df()

    def rows(df):
        cells = lambda x: "" if pd.isna(x) else str(float(x)) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)
        return sorted(tuple(map(cells, r)) for r in df[sorted(df.columns)].astype(object).values.tolist())

    assert rows(got) == rows(want)


def test_edge_cases(spark):
    docs = edge_docs(spark)
    items = spark.createDataFrame([(7, "b c d"), (8, None), (9, "word " * 9)], "item_id long, text string")
    out = [tuple(r) for r in decontamination.decontaminate(docs, items).select("doc_id", "n_words", "n_hit", "n_items").collect()]
    assert sorted(out, key=str) == sorted([(1, 0, 0, 0), (2, 0, 0, 0), (3, 11, 3, 1), (3, 11, 3, 1), (4, 20000, 20000, 1), (None, 2, 0, 0)], key=str)
    assert decontamination.decontaminate(docs.limit(0), items).count() == 0
    assert host_rules.apply_host_rules(docs).count() == len(EDGES)
    assert jaccard.jaccard_components(spark, docs).count() == len(EDGES)
    assert tokens.count_tokens(docs, tokens.default_tokenizer()).count() == len(EDGES)
    assert substring.cut_passages(docs).count() == len(EDGES)
    pieces = packing.pack(docs, tokens.default_tokenizer()).collect()
    assert sum(r["length"] for r in pieces) == sum(len(list(tokens.encoder(tokens.default_tokenizer()).encode([t]))[0]) // 4 + 1 for _, t in EDGES)
    assert packing.pack(docs.limit(0), tokens.default_tokenizer()).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.score(docs, toxicity.train(docs, labels)).count() == len(EDGES)


def test_tokens_equal_the_library():
    enc = tokens.encoder(tokens.default_tokenizer())
    odd = ["a'sb it's WE'RE ''s", "Ünïcödé ÉTÉ ß ς ΑΣ", "x<|endoftext|>y", "é", "日本語 １２", "a\x1cb\x85c", "", "½²µª", "\xad soft İ", "😀!!"]
    for t, ids in zip(odd, enc.encode(odd), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == enc.library.encode(t, add_special_tokens=False).ids


def test_jaccard_against_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for g in range(12):
        base = [f"w{rng.randrange(5000)}" for _ in range(120)]
        for _ in range(12):
            w = list(base)
            for _ in range(rng.randrange(5)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(w)))
    sets = [set(shingles.shingle_set(t).tolist()) for _, t in rows]
    root = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(i):
                both = len(sets[i] & sets[j])
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    root[i] = root[j] = min(root[i], root[j])
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict(enumerate(root))


def test_jaccard_of_open_buckets(spark):
    """A cloud of copies near the threshold and texts that share a passage, in more than small buckets."""
    rng = random.Random(11)
    base, passage = ([f"w{rng.randrange(3000)}" for _ in range(n)] for n in (120, 60))
    rows = []
    for _ in range(150):
        w = list(base)
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        rows.append((len(rows), " ".join(w[: rng.randrange(96, 121)])))
    for _ in range(100):
        w = passage[: rng.randrange(5, 61)] + [f"y{rng.randrange(10**6)}" for _ in range(rng.randrange(12))]
        rows.append((len(rows), " ".join(w)))
    sets = [set(shingles.shingle_set(t).tolist()) for _, t in rows]
    links = [[j for j, y in enumerate(sets) if 100 * len(x & y) >= 80 * len(x | y)] for x in sets]
    want: dict[int, int] = {}
    for first in range(len(rows)):
        todo = [first] if first not in want else []
        while todo:
            i = todo.pop()
            if i not in want:
                want[i] = first
                todo += links[i]
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(set(want.values())) > 20
    assert got == want


def test_packing_pattern_counts():
    rng = random.Random(1)
    histogram = {rng.randrange(1, 101): rng.randrange(1, 50) for _ in range(40)}
    patterns = packing.pack_histogram(histogram, 100)
    back = {}
    for c, lengths in patterns:
        assert sum(lengths) <= 100
        for n in lengths:
            back[n] = back.get(n, 0) + c
    assert back == histogram


def test_shortest_pack_first():
    """Whole counts give what placing one piece after another into the pack filled least gives."""
    rng = random.Random(2)
    for _ in range(30):
        histogram = {rng.randrange(1, 41): rng.randrange(1, 12) for _ in range(rng.randrange(1, 12))}
        packs = []
        for length in sorted((n for n, c in histogram.items() for _ in range(c)), reverse=True):
            least = min(packs, key=sum, default=[])
            if not least or sum(least) + length > 40:
                packs.append([length])
            else:
                least.append(length)
        got = [tuple(lengths) for c, lengths in packing.pack_histogram(histogram, 40) for _ in range(c)]
        assert sorted(map(sum, got)) == sorted(map(sum, packs))


def test_packing_of_whole_texts(spark):
    """Every id lies in one piece, checksums and places are right, and little is padded."""
    import zlib

    path = tokens.default_tokenizer()
    docs = spark.read.parquet(f"{DATA}/documents.parquet").unionByName(edge_docs(spark).drop("tok"))
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    library = tokens.encoder(path).library
    want = sorted(((i, library.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in texts), key=str)
    got = packing.pack(docs, path, 512).collect()
    pieces = sorted((str(i), s, len(ids[s : s + 512]), zlib.crc32(np.array(ids[s : s + 512], "<u4").tobytes()), len(ids)) for i, ids in want for s in range(0, len(ids), 512))
    assert pieces == sorted((str(r["doc_id"]), r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got)
    ends: dict[int, int] = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert ends.get(r["sequence_id"], 0) == r["offset"]
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 512 and sorted(ends) == list(range(len(ends)))
    assert sum(ends.values()) > 0.97 * 512 * (len(ends) - 1)


def test_one_bad_host_is_rejected(spark):
    """A host that fails far more often than others loses its sound documents; a small one is spared."""
    good, bad = "one two three four five six seven eight nine ten eleven", "too short"
    rows = [(1000 * h + i, bad if (i % 5 < 2 if h == 3 else i % 10 == 0) else good, f"h{h}", "x") for h in range(12) for i in range(200)]
    rows += [(90000 + i, bad if i < 1 else good, "tiny", "x") for i in range(2)]
    rows += [(91000, good, None, "x"), (91001, None, "h3", "x"), (None, good, "h1", "x"), (91002, good, "h1", "x"), (91002, good, "h1", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, h string")
    got = host_rules.apply_host_rules(docs)
    lost = got.filter("NOT base_failed AND NOT kept").count()
    assert lost == 120 and got.count() == len(rows)
    frame = docs.toPandas()  # noqa: F841
    con = duckdb.connect()
    con.register("documents", frame)
    want = con.sql(host_rules.ORACLE).df()
    cells = lambda df: sorted(tuple(map(str, r)) for r in df[["n_words", "base_failed", "kept"]].values.tolist())
    assert cells(got.toPandas()) == cells(want)
    same = docs.filter("source IN ('h1', 'h2', 'h4') OR source IS NULL")
    assert host_rules.apply_host_rules(same).filter("NOT base_failed AND NOT kept").count() == 0
    assert host_rules.apply_host_rules(docs.limit(0)).count() == 0


def test_passages_are_found_and_cut(spark):
    rng = random.Random(5)
    words = lambda n: ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n)]
    shared = words(80)
    fuzzy = [("zz" if i in (11, 30, 52) else w) for i, w in enumerate(shared)]
    docs = spark.createDataFrame([(1, " ".join(words(40) + shared)), (2, " ".join(words(30) + fuzzy + words(9))), (3, " ".join(words(200)))], "doc_id long, text string")
    found = substring.passages(docs).collect()
    assert [(r["doc_id"], r["start"], r["n_words"], r["source_id"], r["source_start"]) for r in found] == [(2, 30, 80, 1, 40)]
    left = {r["doc_id"]: len(r["text"].split()) for r in substring.cut_passages(docs).collect()}
    assert left == {1: 120, 2: 39, 3: 200}


@pytest.mark.parametrize("decoys", [1, 12])
def test_passages_whose_seeds_have_other_first_holders(spark, decoys):
    """Decoys hold every five words of the passage, in another order, before its source does."""
    rng = random.Random(decoys)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage = words(50)
    rows = []
    for i in range(decoys):
        at = list(range(46))
        rng.shuffle(at)
        rows.append((i, " ".join(w for k in at for w in passage[k : k + 5] + words(40))))
    rows += [(100, " ".join(words(20) + passage + words(20))), (200, " ".join(words(30) + passage + words(30)))]
    found = substring.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r["doc_id"], r["start"], r["n_words"], r["source_id"], r["source_start"]) for r in found] == [(200, 30, 50, 100, 20)]


def test_altered_passages_of_frequent_seeds_are_found(spark):
    """Decoys before and after the source hold every five words of the passage, so the source is neither the
    first nor the previous holder of any seed, and no run of 50 words is left as it was."""
    rng = random.Random(3)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage = words(80)
    altered = [w if k % 10 != 9 or k > 70 else "other" for k, w in enumerate(passage)]
    decoy = lambda: " ".join(w for k in rng.sample(range(76), 76) for w in passage[k : k + 5] + words(40))
    rows = [(i, decoy()) for i in (*range(10), *range(110, 120))]
    rows += [(100, " ".join(words(20) + passage + words(20))), (200, " ".join(words(30) + altered + words(30)))]
    found = substring.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r["doc_id"], r["start"], r["n_words"], r["source_id"], r["source_start"]) for r in found] == [(200, 30, 80, 100, 20)]


def test_sources_of_one_shared_line_are_not_paired(spark, monkeypatch):
    """A line before a repeated word, which each text repeats another number of times: what two texts share
    is one exact segment, so the second round pairs few of them, and passages made of such pieces are found."""
    rng = random.Random(11)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    line, other = words(18), words(20)
    rows = [(i, " ".join(words(30) + line + ["de"] * (6 + i) + words(40))) for i in range(40)]
    rows += [(100 + i, " ".join(words(30) + ["un"] * (13 + i) + words(40) + other + words(40))) for i in range(20)]
    rows += [(200, " ".join(words(30) + ["un"] * 30 + other + words(30)))]
    sizes, real = {}, substring.settle

    def settle(df, label):
        held = real(df, label)
        sizes[label] = held.count()
        return held

    monkeypatch.setattr(substring, "settle", settle)
    found = substring.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert 0 < sizes["open-sources"] <= 4 * len(rows)
    assert [(r["doc_id"], r["start"], r["n_words"]) for r in found if r["doc_id"] >= 200] == [(200, 30, 50)]


def test_keys_tell_shared_lines_from_other_distances():
    keys = lambda pos, seed: set(zip(*(x.tolist() for x in substring.keys_of(np.array(pos, np.int32), np.array(seed)))))
    assert keys([0, 3, 7], [5, 6, 7]) == keys([40, 43, 47], [5, 6, 7])
    assert not keys([0, 3], [5, 6]) & keys([0, 4], [5, 6]) and not keys([0, 3, 7], [5, 6, 7]) & keys([0, 2, 7], [5, 9, 7])
    assert {f for _, f in keys([0, 20], [5, 6])} == {0} and not keys([0, 40], [5, 6])
    assert keys([0, 1, 2, 3], [5, 5, 5, 5]) == keys([9, 10], [5, 5]) != keys([0, 2], [5, 5])
    assert {k for k, _ in keys([0, 1, 2], [5, 5, 5])} == {k for k, _ in keys([0, 20], [5, 5])}


def test_exact_pieces_stay_beside_chains_of_more_words():
    seg = lambda *rows: np.array([(a, s, n, m, near, 1) for a, s, n, m, near in rows])
    chained, exact = seg((0, 0, 11, 7, 0), (7, 22, 11, 7, 0)), seg((2, 5, 12, 1, substring.LINE))
    assert len(substring.worthwhile([(1, chained), (2, exact)], 50)) == 2
    longer = seg((0, 0, 20, 9, 0))
    assert [x for x, _ in substring.worthwhile([(2, exact), (3, longer)], 50)] == [3]


def test_workers_give_memory_back_after_a_task(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "release", lambda: calls.append(1))
    assert list(common.returning(lambda batches: (2 * b for b in batches))([1, 2])) == [2, 4] and calls == [1]


def test_altered_passages_are_found(spark):
    rng = random.Random(8)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    rows = []
    for i in range(80):
        passage = words(60)
        altered = list(passage)
        for at in sorted(rng.sample(range(60), 9), reverse=True):  # 15 of 100 words
            altered[at : at + 1] = rng.choice([words(1), [], [altered[at], *words(1)]]) if i % 2 else words(1)
        rows += [(2 * i, " ".join(words(40) + passage + words(40))), (2 * i + 1, " ".join(words(30) + altered + words(30)))]
    found = substring.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r["source_id"] == r["doc_id"] - 1 and 50 <= r["n_words"] <= 75 for r in found)
    assert len({r["doc_id"] for r in found}) >= 70


def piece(a, b, m=None, src=1):
    return {"a": a, "b": b, "src": src, "s": a, "m": b - a if m is None else m}


def test_a_passage_stays_beside_short_shared_lines():
    spans = lambda parts: [(x[0], x[1], x[4]) for x in substring.join_pieces(parts, 50, 0.8)]
    assert spans([piece(0, 52), piece(62, 74), piece(84, 96)]) == [(0, 52, 52)]
    assert spans([piece(0, 60), *(piece(a, a + 15) for a in range(70, 195, 25))]) == [(0, 60, 60)]
    assert spans([piece(0, 30), piece(31, 61)]) == [(0, 61, 60)]
    assert spans([piece(0, 60, 48), piece(0, 60, 48, 2)]) == [(0, 60, 48)]


def test_rows_without_an_own_id_are_judged_by_their_text(spark, tmp_path):
    import corpus_pipeline

    text = lambda c: " ".join(f"{c}{i}" for i in range(40))
    rows = [(None, text("a")), (None, text("b")), (None, text("b")), (5, text("c")), (5, text("d")), (3, text("d") + " end"), (7, text("a")), (8, ""), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clash = docs.selectExpr("*", "1 AS id", "2 AS __id", "3 AS __k", "4 AS k", "5 AS e", "6 AS __cuts", "7 AS item")
    assert jaccard.keep_one(spark, clash).columns == clash.columns and substring.cut_passages(clash).count() == len(rows)
    got = jaccard.keep_one(spark, docs).collect()
    want = [(None, text("b")), (5, text("c")), (3, text("d") + " end"), (7, text("a")), (8, ""), (8, None)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    items = [(1, " ".join(text("b").split()[5:20])), (2, " ".join(text("c").split()[5:20]))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.drop_contaminated(spark, clash, str(tmp_path)).count() == 6
    left = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path)).collect()
    assert sorted(map(tuple, left), key=str) == sorted((r for r in rows if r[1] not in (text("b"), text("c"))), key=str)


def held_out(spark, name, column):
    """(predicted, label) of rows outside the training; the smaller tables hold too few labels to learn toxicity."""
    labels = {r["doc_id"]: r[column] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = queries.queries()[name](spark, "/root/testdata/sf0.1").collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    return [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]


@pytest.mark.parametrize("name, column", [("op4_quality_classifier", "quality"), ("op9_toxicity", "toxic")])
def test_held_out_accuracy(spark, name, column):
    pairs = held_out(spark, name, column)
    assert len(pairs) > 300 and sum(a == b for a, b in pairs) >= 0.95 * len(pairs)


def test_flat_trees_equal_a_walk():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 5))
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] < -0.4)).astype(float)
    forest = quality.grow(x, y, trees=12, depth=3)

    def walk(node, row):
        while forest.child[node] != node:
            node = forest.child[node] + int(row[forest.feature[node]] > forest.threshold[node])
        return forest.value[node]

    want = [forest.bias + sum(walk(r, row) for r in forest.roots) for row in x]
    assert np.allclose(forest.margins(x), want) and ((forest.margins(x) > 0) == (y > 0.5)).mean() > 0.9


def test_token_counts_equal_the_library(spark):
    path = tokens.default_tokenizer()
    docs = spark.read.parquet(f"{DATA}/documents.parquet").unionByName(edge_docs(spark).drop("tok"))
    library = tokens.encoder(path).library
    want = [(r["doc_id"], len((r["text"] or "").encode()), len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in docs.collect()]
    got = [(r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in tokens.count_tokens(docs, path).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_every_exact_passage_is_found(spark):
    """Against all runs of 50 words: each that an earlier text holds lies in a passage found for its text."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    words = {r["doc_id"]: shingles.word_hashes(r["text"]) for r in docs.collect()}
    runs = {i: shingles.grams(w, 50) for i, w in words.items()}
    found: dict[int, list] = {}
    for r in substring.passages(docs).collect():
        assert r["source_id"] < r["doc_id"] and r["n_words"] >= 50 and r["n_matched"] >= 0.8 * r["n_words"]
        found.setdefault(r["doc_id"], []).append((r["start"], r["start"] + r["n_words"]))
    seen: set[int] = set()
    checked = 0
    for i in sorted(words):
        inside = np.zeros(len(words[i]), bool)
        for a, b in found.get(i, []):
            inside[a:b] = True
        for at, h in enumerate(runs[i].tolist()):
            if h in seen:
                checked += 1
                assert inside[at : at + 50].all()
        seen.update(runs[i].tolist())
    assert checked > 100


def test_shuffled_plans_give_the_same(spark, monkeypatch):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = lambda df: sorted(map(tuple, df.collect()))
    want = rows(jaccard.jaccard_components(spark, docs)), rows(substring.passages(docs))
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", 0)
    monkeypatch.setattr(substring, "BROADCAST_ROWS", 0)
    assert want == (rows(jaccard.jaccard_components(spark, docs)), rows(substring.passages(docs)))
    items = spark.read.parquet(f"{DATA}/benchmark.parquet")
    want = rows(decontamination.decontaminate(docs, items))
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 0)
    assert want == rows(decontamination.decontaminate(docs, items))


def test_whole_pipeline(spark):
    """run() against what its stages must leave: no linked pair, no item window, each id of each kept text once."""
    import corpus_pipeline

    docs, stages = spark.read.parquet(f"{DATA}/documents.parquet"), dict(corpus_pipeline.STAGES)
    whole = docs
    for name in list(stages)[:-1]:
        docs = corpus_pipeline.settle(stages[name](spark, docs, DATA), "test")
        assert docs.columns == whole.columns
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    texts = {r["doc_id"]: r["text"] for r in whole.collect()}
    assert 0 < len(left) < len(texts) and all(len((t or "").split()) <= len((texts[i] or "").split()) for i, t in left.items())
    items = spark.read.parquet(f"{DATA}/benchmark.parquet")
    assert decontamination.decontaminate(docs, items).filter("n_items > 0").count() == 0
    sets = [set(shingles.shingle_set(t).tolist()) for i, t in left.items() if t == texts[i]]
    assert not any(x and y and 100 * len(x & y) >= 80 * len(x | y) for k, x in enumerate(sets) for y in sets[:k])
    library = tokens.encoder(tokens.default_tokenizer()).library
    want = sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for t in left.values())
    got = corpus_pipeline.run(spark, DATA).collect()
    assert {r["doc_id"] for r in got} == set(left) and sum(r["length"] for r in got) == want


def test_pages_with_missing_columns_and_repeats(spark):
    page = "<p>" + "x" * 1500
    rows = [(1, "u", page), (2, None, page), (2, None, page), (3, "v", None), (4, "v", ""), (None, "w", "y")]
    got = warc.archive_pages(spark, spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, record_type int")).collect()
    assert sorted(((r["page_id"], r["payload_bytes"]) for r in got), key=str) == sorted(((r[0], len((r[2] or "").encode())) for r in rows), key=str)
    assert sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in got if r["payload_bytes"] > 1000) == [(1, "revisit", 2), (2, "response", None), (2, "response", None)]
    text = html.extract_main_text(spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, w int"))
    assert text.count() == len(rows) and html.extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_swapped_identities_do_not_matter():
    index = {t: i for i, t in enumerate([t for kind in toxicity.IDENTITIES for t in kind] + ["bad"])}
    x, y = np.zeros((80, len(index)), np.float32), np.zeros(80, np.float32)
    x[:40, index["muslim"]] = x[:40, index["bad"]] = y[:40] = 1
    plain, _ = toxicity.fit(x, y, np.zeros((0, len(index)), np.float32), 1.0, 1e-3)
    texts = ["a muslim bad"] * 40 + [""] * 40
    swapped = toxicity.presence([[index[f] for f in toxicity.features_of(t, True) & index.keys()] for t in texts], len(index))
    fair, _ = toxicity.fit(x, y, toxicity.swaps(x, swapped), 20.0, 1e-3)
    gap = lambda w: abs(w[index["muslim"]] - w[index["christian"]])
    swap = lambda w: abs(w[index["muslim"]] - w[index["jewish"]])
    assert swap(fair) < swap(plain) / 2 and gap(fair) <= gap(plain)


def test_counterfactual_copies_swap_word_beginnings_too():
    assert toxicity.features_of("A Muslim sat", True) == toxicity.features_of("a jewish sat")


def test_main_text():
    page = "<html><head><title>t</title></head><body><nav><ul><li><a href=/a>Home</a></li></ul></nav><article><h1>Head line</h1><p><b>One &amp; two words here.<br><p>More   words in the article.</article><div class=comments><p>Reader says no.</p></div><footer>&copy; x.com</footer>"
    assert html.main_texts(html.labeller(), [page, None, ""]) == ["Head line One & two words here. More words in the article.", "", ""]


def test_blocks_are_judged_by_their_whole_text():
    """Blocks that are alike in length, in their first 2,000 characters and at both ends differ by their middle."""
    ends = "one two three four " + "word " * 400, " five six seven eight."
    for one, other in (("plain " * 100, "pla,n " * 100), ("plain " * 100, "other " * 100)):
        x, y = (html.vectors([((frozenset(), ()), ends[0] + middle.strip() + ends[1], 0)]) for middle in (one, other))
        assert (x != y).any()


def test_deep_pages_share_their_paths():
    """Blocks at any depth hold one set of slots and two elements, so work grows with the page alone. (By
    time: 2,000 open elements 0.02 s, 32,000 0.36 s; the clock is no test, as collections of garbage differ.)"""
    blocks = html.blocks_of("<div class='a b'>word" * 5000)
    assert len(blocks) == 5000 and all(path[0] is blocks[0][0][0] and len(path[1]) <= 2 for path, _, _ in blocks)


def test_salvage():
    row = lambda i: {"html": "h" * 2000 + str(i), "record_type": "response", "page_id": i, "url": "u", "refers_to": None}
    raws = [warc.member(warc.capture(row(i))) for i in range(4)]
    broken = bytearray(raws[1])
    broken[40] ^= 255
    data = raws[0] + bytes(broken) + raws[2] + b"junk" + raws[3]
    got = list(warc.read_archive(io.BytesIO(data)))
    assert [x.headers["x-page-id"] for x in got if isinstance(x, warc.Record)] == ["0", "2", "3"]
    assert [(x.offset, x.length) for x in got if isinstance(x, warc.Gap)] == [(len(raws[0]), len(raws[1])), (len(raws[0] + raws[1] + raws[2]), 4)]


def test_records_that_cannot_be_read_back_fail_the_job(spark, tmp_path):
    row = lambda i: {"html": "h" * 2000 + str(i), "record_type": "response", "page_id": i, "url": "u", "refers_to": None}
    raws = [bytearray(warc.member(warc.capture(row(i)))) for i in range(3)]
    files = spark.createDataFrame([(f"file://{tmp_path}/x.warc.gz",)], "path string")
    (tmp_path / "x.warc.gz").write_bytes(b"".join(raws))
    assert warc.complete(warc.read_archives(files), 3).count() == 3
    with pytest.raises(ValueError):
        warc.complete(warc.read_archives(files), 4)
    raws[1][40] ^= 255
    (tmp_path / "x.warc.gz").write_bytes(b"".join(raws))
    with pytest.raises(ValueError):
        warc.complete(warc.read_archives(files), 3)


def test_decontamination_edges_on_both_plans(spark, monkeypatch):
    """Null, empty, repeated and wordless rows, few-word items and empty tables, with windows broadcast and shuffled."""
    docs = spark.createDataFrame([(None, None, 1), (None, "", 1), (1, "A b", 1), (1, "A b", 1), (1, "\x01 c", 1), (2, "x a b y a b", 1)], "doc_id long, text string, k int")
    items = spark.createDataFrame([("i", "a B"), ("j", "b"), ("n", None), (None, "x"), ("e", "..")], "item_id string, text string")
    got = []
    for most in (decontamination.BROADCAST_WINDOWS, 0):
        monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", most)
        out = decontamination.decontaminate(docs, items).select("doc_id", "n_words", "n_hit", "n_items", "contaminated")
        got.append(sorted((tuple(r) for r in out.collect()), key=str))
        assert decontamination.decontaminate(docs, items.limit(0)).count() == 6 and decontamination.decontaminate(docs.limit(0), items).count() == 0
    want = [(None, 0, 0, 0, False)] * 2 + [(1, 2, 2, 2, True)] * 2 + [(1, 1, 0, 0, False), (2, 6, 5, 2, True)]
    assert got == [sorted(want, key=str)] * 2
