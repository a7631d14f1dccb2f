"""The operators against brute force, and on awkward tables."""

import hashlib
import itertools
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pageloom.llm import (
    decontamination,
    graph,
    language_id,
    licenses,
    lm_scoring,
    ngram_join,
    packing,
    pii,
    quality,
    queries,
    suffix_dedup,
    suffix_sort,
    token_counts,
)
from pageloom.llm.tokens import vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, key string, uid long, size long"
BPE, PIECES = "word_bpe_49k.json", "piece_bpe_32k.model"


def _prose(rng, n):
    return " ".join(f"w{rng.randrange(900)}" for _ in range(n))


def _documents():
    rng = random.Random(3)
    shared, item = _prose(rng, 110), _prose(rng, 40)
    rows = []
    for i in range(40):
        text = _prose(rng, 120)
        if i % 5 == 1:
            text = text[:300] + " " + shared + " " + text[300:]
        if i % 5 == 2:
            text = f"{text} {item}"
        if i % 5 == 3:
            words = rows[i - 3][1].split()
            words[60] = "changed"
            text = " ".join(words)
        rows.append((i, text))
    rows += [(50, None), (51, ""), (52, " \n\t"), (53, "x"), (54, "é" * 3000), (None, rows[0][1])]
    rows += [(60, rows[1][1]), (60, rows[1][1]), (61, "ab " * 400)]
    return rows, item


@pytest.fixture(scope="module")
def docs(spark):
    rows, _ = _documents()
    full = [(i, t, "en" if n % 2 else None, None, "clash", 1, 2) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(5)


def _ids_of(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary(BPE)).encode(text or "", add_special_tokens=False).ids + [1]


def test_packing_holds_every_id_once(docs):
    rows, _ = _documents()
    got = packing.pack_documents(docs, vocabulary(BPE), capacity=64, with_ids=True).collect()
    expected = Counter(tuple(_ids_of(t)) for _, t in rows)
    pieces = defaultdict(list)
    for r in got:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        pieces[r.sequence_id].append(r)
    for own in pieces.values():
        own.sort(key=lambda r: r.offset)
        total = 0
        for r in own:
            assert r.offset == total
            total += r.length
        assert total == 64 or total & (total - 1) == 0
    for i in {r.doc_id for r in got} - {60}:
        own = sorted((r for r in got if r.doc_id == i), key=lambda r: r.start)
        assert tuple(itertools.chain.from_iterable(r.ids for r in own)) in expected
    assert sum(r.length for r in got) == sum(len(k) * n for k, n in expected.items())


def test_decontamination_finds_edited_items(spark, docs):
    rows, item = _documents()
    edited = item[:50] + "Z" + item[53:]
    benchmark = spark.createDataFrame([(7, edited), (8, None), (9, "short")], "item_id long, text string")
    got = {r.doc_id: r.distance for r in decontamination.benchmark_matches(docs, benchmark).collect()}
    assert set(got) == {i for i, t in rows if t and item in t}
    assert all(0 < d <= 8 for d in got.values())


def _edits(pattern, text):
    """Least edits that turn the pattern into a part of the text, by the whole table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_decontamination_equals_plain_edit_distance(spark):
    rng = random.Random(11)
    items = [(i, "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(30, 140))).strip()) for i in range(6)]
    items += [(6, "ab " * 30), (7, "x" * 50), (8, "abc abd " * 12), (9, "ab " * 20 + "c" + "ab " * 20)]
    texts = [(0, None), (1, ""), (2, "ab " * 90), (3, "ab " * 40 + "d" + "ab " * 50), (4, "x" * 49 + "y" + "x" * 30), (5, "x" * 45)]
    for k in range(40):
        inner = list(rng.choice(items)[1])
        for _ in range(rng.randrange(14)):
            at = rng.randrange(len(inner))
            inner[at] = rng.choice(["", "q", inner[at] + "zz"])
        before = "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(80)))
        texts.append((10 + k, before + "".join(inner) + before[::-1]))
    texts.append(texts[-1])
    want = []
    for doc, text in texts:
        for p in decontamination.patterns(items, 0.08, 512):
            distance = _edits(p.points.tolist(), list(map(ord, decontamination.normal(text or ""))))
            if distance <= p.budget:
                want.append((doc, p.item, distance))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for block_bytes in (8 << 20, 200):
        got = decontamination.benchmark_matches(docs, benchmark, block_bytes=block_bytes).collect()
        rows = sorted((r.doc_id, r.item_id, r.distance) for r in got)
        assert (rows if block_bytes > 200 else sorted(set(rows))) == (sorted(want) if block_bytes > 200 else sorted(set(want)))
    assert len(want) >= 25 and {d for _, _, d in want} > {0, 1, 2}


def test_decontamination_of_long_repetitive_texts():
    """Memory and time are bounded where every band meets the lemma's bound."""
    import tracemalloc

    items = [(1, "ab " * 170), (2, "abc abd " * 40), (3, "x" * 300 + "y" + "x" * 100)]
    index = decontamination.Index(decontamination.patterns(items, 0.08, 512))
    for text, want in (("ab " * 350_000, {1: (0, 0, 509)}), ("x" * 400_000, {3: (1, 0, 401)})):
        points = np.array(list(map(ord, decontamination.normal(text))), np.uint32)
        tracemalloc.start()
        found = index.search(points, index.hits(points))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert {i: (d, max(0, s), e) for i, (d, s, e) in found.items()}.keys() == want.keys()
        assert [x[0] for x in found.values()] == [x[0] for x in want.values()]
        assert peak < 200 << 20


def test_rollup_batches_count_once(spark, docs, tmp_path):
    rollup = token_counts.TokenRollup(spark, str(tmp_path), {"words-1": token_counts.word_count})
    rows = docs.filter("doc_id < 40")
    rollup.commit(1, rows.withColumn("kind", F.lit("insert")))
    gone = rows.filter("doc_id < 10").withColumn("kind", F.lit("delete"))
    rollup.commit(2, gone)
    rollup.commit(2, gone)
    revised = rows.filter("doc_id = 20").withColumns({"kind": F.lit("revise"), "text": F.lit("a b")})
    rollup.commit(3, revised)
    total = rollup.totals().agg(F.sum("docs"), F.sum("tokens")).first()
    texts = [(i, t) for i, t in _documents()[0] if i is not None and 10 <= i < 40]
    assert tuple(total) == (30, sum(2 if i == 20 else len(t.split()) for i, t in texts))


def test_rollup_goes_on_from_its_folder(spark, docs, tmp_path):
    def opened():
        return token_counts.TokenRollup(spark, str(tmp_path / "rollup"), {"words-1": token_counts.word_count})

    def sums():
        return tuple(opened().totals().agg(F.sum("docs"), F.sum("tokens")).first())

    assert opened().totals().count() == 0
    rows = docs.filter("doc_id < 40")
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        opened().commit(1, rows.withColumn("kind", F.lit("insert")))
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    for _ in range(2):
        opened().commit(2, rows.filter("doc_id < 10").withColumn("kind", F.lit("delete")))
    opened().commit(3, rows.filter("doc_id = 20").withColumns({"kind": F.lit("revise"), "text": F.lit("a b")}))
    texts = [(i, t) for i, t in _documents()[0] if i is not None and 10 <= i < 40]
    whole = (30, sum(2 if i == 20 else len(t.split()) for i, t in texts))
    assert sums() == whole
    # A batch whose writing broke off does not count until it is committed again.
    more = docs.filter("doc_id = 21").withColumn("kind", F.lit("delete"))
    broken = more.withColumn("doc_id", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        opened().commit(4, broken)
    assert sums() == whole
    # Nor does a retry of a committed number that fails, or succeeds, change anything.
    assert opened().commit(3, broken) is False and opened().commit(1, more) is False
    assert sums() == whole
    assert opened().commit(4, more) and sums()[0] == 29


def test_quality_measurements(docs):
    got = quality.apply_policy(quality.rule_ledger(docs), 2)
    rows = {r.doc_id: r for r in got.collect()}
    assert (rows[50].n_words, rows[50].kept) == (0, False)
    assert rows[61].n_repeat_words == 400 and rows[0].kept
    out = {r["rule"]: r["failing"] for r in quality.ablations(got, 1).collect()}
    assert out["few_words"] == sum(r.n_words < 20 for r in rows.values())


def test_lm_scores(docs):
    held = docs.withColumn("held_out", F.col("doc_id") == 3)
    rows = {r.doc_id: r for r in lm_scoring.scores(held).collect()}
    assert rows[50].n_tokens == 1 and rows[3].held_out and all(r.score < 0 for r in rows.values())
    assert rows[3].score > rows[3].base_score  # a near copy of a training text


def test_licenses(spark):
    lines = ["Released under the MIT License.", "nothing here", "All rights reserved.", "He lost his license."]
    rows = spark.createDataFrame([(1, "\n".join(lines)), (2, None), (3, "")], "doc_id long, text string")
    got = {(r.line, r.family, r.confirmed) for r in licenses.license_paragraphs(rows).collect()}
    assert {(0, "mit", True), (2, "proprietary", True)} <= got and all(n != 1 for n, *_ in got)


def _sets(rows):
    for i, t in rows:
        w = WORD.findall((t or "").lower())
        yield i, {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()


def test_ngram_join_equals_brute_force(docs, monkeypatch):
    sets = list(_sets(_documents()[0]))
    root = list(range(len(sets)))
    for _ in sets:
        for a, b in itertools.combinations(range(len(sets)), 2):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                root[a] = root[b] = min(root[a], root[b])
    smallest = {}
    for n, (i, s) in enumerate(sets):
        if i is not None:
            smallest[root[n]] = min(i, smallest.get(root[n], i))
    expected = Counter((i, len(s), smallest.get(root[n])) for n, (i, s) in enumerate(sets))
    for grams, blocks, part, asked in ((1_000_000, 24, 1_000_000, 65_536), (200, 24, 50, 3), (200, 1, 500, 1)):
        monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", grams)
        monkeypatch.setattr(ngram_join, "MOST_BLOCKS", blocks)
        monkeypatch.setattr(ngram_join, "PART_GRAMS", part)
        monkeypatch.setattr(ngram_join, "BLOCK_SETS", asked)
        got = Counter(tuple(r) for r in ngram_join.similar_components(docs).collect())
        assert got == expected


def test_pipeline_keeps_one_row_of_each_component(spark):
    import corpus_pipeline

    rng = random.Random(11)
    a, b, c, d, e = (_prose(rng, 60) for _ in range(5))
    near = a + " more"
    rows = [(1, a), (2, near), (3, b), (3, c), (4, b), (None, d), (None, d), (None, c + " more"), (5, d), (None, e), (None, e), (6, ""), (6, ""), (7, a), (7, b), (8, None)]
    table = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.without_near_duplicates(spark, table, "").collect()
    want = [(1, a), (3, b), (3, c), (5, d), (None, e), (6, ""), (8, None)]
    assert Counter((r.doc_id, r.text) for r in kept) == Counter(want)


def test_divide_skip_equals_counting():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 400, 60)
    sets = [np.unique(np.r_[base[: rng.integers(40, 60)], rng.integers(0, 400, 9)]).astype(np.uint64) for _ in range(60)]
    overlap = ngram_join.Overlap(75)
    lists = ngram_join.Lists(sets, overlap)
    for limit in (0, 10**9):
        ngram_join.COUNTED, old = limit, ngram_join.COUNTED
        for i in range(60):
            expected = [j for j in range(i + 1, 60) if ngram_join.linked(sets[i], sets[j], overlap)]
            assert lists.search(i) == expected
        ngram_join.COUNTED = old


def test_search_of_near_copies_takes_few_steps(monkeypatch):
    # A group of near copies: found sets were looked up list by list, each by a call of its own.
    rng = np.random.default_rng(2)
    base = np.arange(140)
    sets = [np.r_[base[rng.permutation(140)[:130]], rng.integers(10**6, 10**9, 12)] for _ in range(300)]
    sets = [np.unique(s).astype(np.uint64) for s in sets]
    overlap = ngram_join.Overlap(75)
    calls = []

    def profile(frame, event, arg):
        if event == "c_call" and arg.__name__ == "searchsorted":
            calls.append(1)

    lists = ngram_join.Lists(sets, overlap)
    for gathered, looked_up in ((4_000_000, 30), (1, 10**9), (50, 0)):
        monkeypatch.setattr(ngram_join, "GATHERED", gathered, raising=False)
        monkeypatch.setattr(ngram_join, "LOOKED_UP", looked_up, raising=False)
        for i in (0, 7, 298, 299):
            expected = [j for j in range(i + 1, 300) if ngram_join.linked(sets[i], sets[j], overlap)]
            calls.clear()
            sys.setprofile(profile)
            try:
                found = lists.search(i)
            finally:
                sys.setprofile(None)
            assert found == expected
            assert len(calls) < 200


def test_only_texts_of_likely_members_go_on(spark):
    rows = spark.range(-3000, 3000).select(F.col("id").alias("uid"), F.col("id").cast("string").alias("text"))
    for step in (1000, 7):
        members = rows.filter(F.col("uid") % step == 0).select("uid", F.lit(1).alias("key"))
        wanted = {r.uid for r in members.collect()}
        got = [(r.uid, r.text) for r in ngram_join._likely(rows, members).collect()]
        assert wanted <= {u for u, _ in got} and all(t == str(u) for u, t in got)
        assert len(got) == len(set(got)) < len(wanted) + 600
    assert ngram_join._likely(rows, members.limit(0)).count() == 0


def test_stars():
    a, b = np.array([5, 4, 9, -2, 9, 3]), np.array([4, 1, 8, 7, 8, 3])
    assert sorted(zip(*(x.tolist() for x in graph.stars(a, b)))) == [(4, 1), (5, 1), (7, -2), (9, 8)]


def test_links_that_one_task_reads_need_no_round(spark, monkeypatch):
    names = []
    kept = graph.stored
    monkeypatch.setattr(graph, "stored", lambda df, name: (names.append(name), kept(df, name))[1])
    links = spark.createDataFrame([(i + 1, i) for i in range(30)], "a long, b long").repartition(4)
    got = {r.node: r.component for r in graph.components(links, "test").collect()}
    assert got == {i: 0 for i in range(31)}
    assert "test-0" not in names
    # Chunks of one link: rounds are needed.
    monkeypatch.setattr(graph, "CHUNK", 1, raising=False)
    got = {r.node: r.component for r in graph.components(links, "test").collect()}
    assert got == {i: 0 for i in range(31)}


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(30) if i != 14], "a long, b long")
    got = {r.node: r.component for r in graph.components(links, "test").collect()}
    assert got == {i: 0 if i < 15 else 15 for i in range(31)}


@pytest.mark.parametrize("cell_rows", [512, 1])
def test_repeats_equal_brute_force(docs, monkeypatch, cell_rows):
    monkeypatch.setattr(suffix_dedup, "CELL_ROWS", cell_rows)
    rows, length = [(i, (t or "").encode()) for i, t in _documents()[0]], 100
    seen = Counter(t[p : p + length] for _, t in rows for p in range(len(t) - length + 1))
    expected = Counter()
    for i, t in rows:
        mark = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                mark[p : p + length] = b"\1" * length
        kept = bytes(c for c, m in zip(t, mark) if not m)
        runs = len(re.findall(rb"\x01+", bytes(mark)))
        expected[i, len(t), sum(mark), runs, hashlib.sha256(kept).hexdigest()] += 1
    assert Counter(tuple(r) for r in suffix_dedup.remove_repeats(docs, length=length).collect()) == expected


def test_repeats_leave_their_texts_readable(spark, docs, tmp_path):
    """One row per row, copies among them; the bytes left are those that are digested."""
    rows = suffix_dedup.remove_repeats(docs, length=100, with_text=True).collect()
    plain = suffix_dedup.remove_repeats(docs, length=100).collect()
    assert Counter(tuple(r)[:-1] for r in rows) == Counter(tuple(r) for r in plain)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in rows)
    assert all(len(r.kept) == r.n_bytes - r.n_removed for r in rows)
    # The query: a passage of 400 bytes goes, a shorter one stays, a parted é shows as U+FFFD.
    rng = random.Random(8)
    long, short = _prose(rng, 120), _prose(rng, 60)
    assert len(long) >= 400 > len(short) + 4
    a, b, c, d = (_prose(rng, 50) for _ in range(4))
    texts = [f"1{a}|{long}é{b}", f"2{c}|{long}è{d}", f"3{a}#{short}#{d}", f"4{c}%{short}%{b}", c * 3, c * 3, None, ""]
    schema = "doc_id long, text string"
    spark.createDataFrame(list(enumerate(texts)), schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op8_repeated_bytes(spark, str(tmp_path)).collect()}
    assert [got[i].text for i in range(8)] == [f"1{a}\ufffd{b}", f"2{c}\ufffd{d}", *texts[2:4], "", "", "", ""]
    assert [got[i].n_removed for i in range(8)] == [len(long) + 2] * 2 + [0, 0, len(c) * 3, len(c) * 3, 0, 0]


def test_deep_shallow_sort_orders_suffixes():
    data = np.frombuffer(b"abcabcabd" * 40, np.uint8)
    starts = np.arange(200)
    order, same = suffix_sort.sorted_groups(data, starts, np.zeros(200, np.int64), 100)
    text = [data[s : s + 100].tobytes() for s in starts[order]]
    assert text == sorted(text)
    assert same.tolist() == [False] + [a == b for a, b in zip(text, text[1:])]


def test_language_id(spark, docs):
    rows = [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr")] * 5
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), vocabulary(PIECES))
    asked = spark.createDataFrame([(1, "the dog"), (2, "LE CHIEN"), (3, None), (4, "12 !")], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score > 0.5) for r in language_id.identify(asked, model).collect()}
    assert got == {1: ("en", True), 2: ("fr", True), 3: ("und", False), 4: ("und", False)}
    assert language_id.identify(docs, model).count() == docs.count()


def test_language_of_letters_too_rare_for_doubles(spark):
    """Long runs of unseen scripts are asked and learned; no score is lost."""
    odd = ["中" * 60, "ไ" * 80, "ሀ" * 48, "中" * 20_000, "ab" * 40]
    rows = [(i, "the cat and the dog", "en") for i in range(40)] + [(i, "le chat et le chien", "fr") for i in range(40)]
    learned = spark.createDataFrame(rows + [(99, t, "en") for t in odd], "doc_id long, text string, lang string")
    asked = spark.createDataFrame(list(enumerate([*odd, "the dog", "le chien"])), "doc_id long, text string")
    for table in (learned, learned.filter("doc_id < 99")):
        model = language_id.train(table, vocabulary(PIECES))
        assert np.isfinite(model.table).all() and (model.table[:-1] > 0).all()
        got = {r.doc_id: r for r in language_id.identify(asked, model).collect()}
        assert all(0 <= r.score <= 1 and np.isfinite(r.nats_per_letter) for r in got.values())
        assert (got[5].lang_pred, got[6].lang_pred) == ("en", "fr")


def test_logarithms_equal_plain_sums(spark, monkeypatch):
    rng = np.random.default_rng(1)
    own = language_id.pieces(vocabulary(PIECES))
    words = pa.array(["the", "chien", "internationalisation", "中文", "x" * 48], pa.large_string())
    table = language_id._table(rng.random((own.size, 3)))
    counts = rng.random((len(words), 3))
    plain = language_id.word_scores(words, table, own), language_id.expected_counts(words, counts, table, own)
    monkeypatch.setattr(language_id, "_LEAST", 2.0)
    logs = language_id.word_scores(words, table, own), language_id.expected_counts(words, counts, table, own)
    assert np.allclose(plain[0], logs[0]) and np.allclose(plain[1], logs[1])


def test_pipeline_without_labels_keeps_rows(spark, docs):
    import corpus_pipeline

    rows = docs.withColumn("n_chars", F.lit(1)).withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.in_known_language(spark, rows, "").count() == docs.count()


def test_pseudonyms_are_valid_and_reversible():
    text = "4111 1111 1111 1111, 10.2.3.4 a.b7@mail.example.com +1 (663) 555-6869 2024-02-29 123-45-6789 4111111111111112"
    there, spans = pii.Pseudonyms(b"k").replace(text)
    assert [s[0] for s in spans] == ["card", "ip", "email", "phone", "date", "ssn"]
    assert there.endswith("4111111111111112") and all(text[s[1] : s[2]] not in there for s in spans)
    assert pii.Pseudonyms(b"k", inverse=True).replace(there)[0] == text
    assert pii.Pseudonyms(b"k").replace(there)[1]  # still valid numbers
    permute = pii.Permutation(b"k")
    assert sorted(permute(i, 137, b"t") for i in range(137)) == list(range(137))


def test_pseudonyms_keep_rows(docs):
    got = pii.pseudonymize(docs, b"k", keep=["lang", "source"])
    assert got.count() == docs.count() and got.filter("doc_id = 50").first().text is None


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    model = language_id.train(none, vocabulary(PIECES))
    assert {r.lang_pred for r in language_id.identify(docs, model).collect()} == {"und"}
    results = [
        packing.pack_documents(none, vocabulary(BPE)), quality.rule_ledger(none), licenses.license_paragraphs(none),
        ngram_join.similar_components(none), suffix_dedup.remove_repeats(none), pii.pseudonymize(none, b"k"),
        lm_scoring.scores(none.withColumn("held_out", F.lit(False))),
        decontamination.benchmark_matches(docs, spark.createDataFrame([], "item_id long, text string")),
    ]
    assert [r.count() for r in results] == [0] * len(results)


def test_license_rows_that_decide_nothing(spark):
    texts = [(1, None), (2, ""), (3, "in this is by that, all of the"), (4, "License"), (5, "a\nSPDX-License-Identifier: MIT"), (5, "a\nSPDX-License-Identifier: MIT")]
    rows = spark.createDataFrame(texts, "doc_id long, text string").withColumn("line", F.lit("x"))
    got = [tuple(r) for r in licenses.license_paragraphs(rows).filter("confirmed").select("doc_id", "line", "family").collect()]
    assert got == [(5, 1, "mit")] * 2


def test_license_neighbours_are_not_confirmed(spark):
    families = {
        "apache-2.0": "Licensed under the Apache License, Version 2.0.",
        "mit": "Released under the MIT License.",
        "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
        "bsd-3-clause": "Released under the BSD 3-Clause License.",
        "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
        "proprietary": "All rights reserved.",
    }
    others = [
        "This work is licensed under the GNU General Public License, version 2.",
        "Licensed under the GNU Lesser General Public License, version 3.",
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-NC-SA 4.0.",
        "Released under the BSD 2-Clause License.",
        "Licensed under the Apache License, Version 1.1.",
        "SPDX-License-Identifier: MIT-0",
    ]
    rows = spark.createDataFrame([(1, "\n".join([*families.values(), *others]))], "doc_id long, text string")
    found = licenses.license_paragraphs(rows).filter("confirmed").collect()
    assert [(r.line, r.family) for r in sorted(found)] == list(enumerate(families))


def test_license_classes_are_calibrated(spark):
    _, _, bias, least = licenses.train()
    assert 0.5 <= least < 1 and bias[-1] == bias.max() and len(set(bias[:-1])) > 1
    trained = {*sum(licenses.TEMPLATES.values(), []), *sum(licenses.WORDINGS.values(), [])}
    trained |= {*licenses.OTHERS, *licenses.OTHER_LICENSES}
    held = [(c, t) for c, texts in licenses.HELD_OUT.items() for t in texts]
    assert not trained & {t for _, t in held}
    rows = spark.createDataFrame(list(enumerate(t for _, t in held)), "doc_id long, text string")
    found = {r.doc_id: r.family for r in licenses.license_paragraphs(rows).collect()}
    assert [found.get(i, licenses.UNKNOWN) for i in range(len(held))] == [c for c, _ in held]
