"""Corpus operators on small hand-made tables and against brute-force versions."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from veerline.llm import decontaminate, gam, license_scan, mixing, ngram_join, quality_rules, sharding, token_file, toxicity, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _n string, row string, k string"


def table(spark, rows):
    """Documents with extra columns whose names clash with those inside the operators."""
    return spark.createDataFrame(
        [(i, t, "en", s, len(t or ""), "x", "y", "z") for i, t, s in rows], SCHEMA
    )


def words(seed: int, n: int) -> str:
    r = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in r.integers(0, 5000, n))


@pytest.fixture(scope="module")
def odd():
    """Nulls, empty and very long texts, ties and repeated rows."""
    return [
        (None, None, None), (1, "", "a"), (2, words(1, 60), "a"), (2, words(1, 60), "a"), (3, words(2, 6000), None),
        (4, words(3, 80), "b"), (None, words(3, 80), "b"), (5, "é ß 数据 \n\n x", "c"), (-7, " \t ", "c"),
    ]


EMPTY: list = []


def test_every_operator_takes_odd_and_empty_tables(spark, odd):
    bench = spark.createDataFrame([(1, words(3, 30)), (None, "x"), (2, None), (3, "")], "item_id long, text string")
    for rows in (odd, EMPTY):
        docs = table(spark, rows)
        assert sharding.shard(docs).count() == len(rows)
        assert license_scan.scan_licenses(docs).count() == len(rows)
        assert gam.classify(docs, gam.fit(np.zeros((0, len(gam.FEATURES))), np.zeros(0))).count() == len(rows)
        assert decontaminate.contaminated(docs, bench).count() == len(rows)
        assert mixing.mix(docs).count() == len(rows)
        assert quality_rules.quality_rules(docs).count() == len(rows)
        assert ngram_join.ngram_join(docs).count() == len(rows)
        model = toxicity.Model(b"", b"", toxicity.calibrate([]))
        assert toxicity.classify(docs, model).count() == len(rows)
        for kept in (quality_rules.keep_good(docs), ngram_join.keep_first(docs), decontaminate.without_leaks(docs, bench), mixing.mixed(docs)):
            assert kept.columns == docs.columns and kept.count() <= 3 * len(rows)


def test_shards_are_level_and_slots_gapless(spark):
    r = np.random.default_rng(4)
    rows = [(i, "x" * int(r.pareto(1.5) * 200), "a") for i in range(4000)] + [(9000 + i, "same text " * 20, "a") for i in range(2000)]
    found = sharding.shard(table(spark, rows)).select("row.doc_id", "size", "shard", "slot").collect()
    assert sorted(x.doc_id for x in found) == sorted(i for i, _, _ in rows)
    total, slots = Counter(), defaultdict(list)
    for x in found:
        total[x.shard] += x["size"]
        slots[x.shard].append(x.slot)
    mean = sum(total.values()) / 8
    assert len(total) == 8 and all(abs(v - mean) < 0.06 * mean + max(x["size"] for x in found) for v in total.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_mix_against_rounds_of_sharing(spark):
    rows = [(i, "w " * (1 + i % 7), "abcd"[i % 4] if i % 9 else None) for i in range(300)] + [(999, "w " * 4000, "z")]
    found = mixing.mix(table(spark, rows)).select("row.doc_id", "row.source", "size", "source_size", "target", "taken").collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    names = sorted([s for s in sizes if s is not None]) + [None]
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    target, full = {}, set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        share = sum(weight[s] for s in names if s not in full)
        target = {s: 3 * sizes[s] if s in full else left * weight[s] / share for s in names}
        above = {s for s in names if target[s] > 3 * sizes[s] + 1e-9}
        if not above:
            break
        full |= above
    taken = Counter()
    for x in found:
        assert abs(x.target - target[x.source]) < 1e-6 and x.source_size == sizes[x.source]
        assert 0 <= x.taken <= 3 * x["size"]
        taken[x.source] += x.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in names)
    out = mixing.mixed(table(spark, rows)).collect()
    texts = {i: t for i, t, _ in rows}
    assert all(x.text == texts[x.doc_id] for x in out) and max(Counter(x.doc_id for x in out).values()) <= 3
    for s in names:
        biggest = max(len(t.split()) for _, t, x in rows if x == s)
        assert abs(sum(len(x.text.split()) for x in out if x.source == s) - target[s]) <= biggest / 2 + 1


def jaccard_classes(texts: list[str], n: int = 5) -> list[set]:
    sets = []
    for t in texts:
        w = re.findall(r"\w+", t.lower())
        k = min(n, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set())
    return sets


def test_join_against_all_pairs(spark):
    texts = []
    for i in range(12):
        base = words(100 + i, 120).split()
        texts.append(" ".join(base))
        for j in range(1, 6):
            changed = list(base)
            for at in range(j):
                changed[(at * 31 + j) % 120] = f"other{j}{at}"
            texts.append(" ".join(changed))
    texts += [texts[0]] * 5 + ["short one", "short one", ""]
    sets = jaccard_classes(texts)
    root = list(range(len(texts)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] == sets[b] or both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    docs = table(spark, [(i, t, "a") for i, t in enumerate(texts)])
    found = {x.doc_id: x for x in ngram_join.ngram_join(docs).collect()}
    assert [found[i].class_id for i in range(len(texts))] == [top(i) for i in range(len(texts))]
    assert found[0].n_copies == 6 and found[len(texts) - 1].n_links == 0
    kept = {x.doc_id for x in ngram_join.keep_first(docs).collect()}
    assert len(kept) == len({top(i) for i in range(len(texts))})


@pytest.mark.parametrize("block", [256, 16])
def test_join_counts_every_link_between_different_texts(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", block)
    texts = []
    for group, m in ((0, 60), (1, 2), (2, 9)):
        base = words(300 + group, 200).split()
        for j in range(m):
            # One word of 200 differs: any two of a group have a similarity of at least 0.9.
            texts.append(" ".join([*base[: 10 + 3 * j], f"other{j}", *base[11 + 3 * j :]]))
    texts += [texts[0]] * 3 + [texts[65]] + [words(400, 50), ""]
    sets = jaccard_classes(texts)
    links = [0] * len(texts)
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] == sets[b] or both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
    found = {x.doc_id: x.n_links for x in ngram_join.ngram_join(table(spark, [(i, t, "a") for i, t in enumerate(texts)])).collect()}
    assert [found[i] for i in range(len(texts))] == links
    assert links[0] == links[59] == 62 and links[60] == 1


def test_shared_grams_of_many_pairs_are_exact(monkeypatch):
    monkeypatch.setattr(ngram_join, "WIDTH", 64)
    r = np.random.default_rng(7)
    sets = [np.unique(r.integers(0, 900, int(r.integers(1, 600)))).astype("uint32") for _ in range(30)]
    x, y = np.triu_indices(30, 1)
    assert ngram_join._shared(sets, x, y).tolist() == [len(set(sets[a]) & set(sets[b])) for a, b in zip(x, y)]


def test_bands_reach_the_recall():
    bands, rows = ngram_join.bands_for()
    assert bands * rows <= ngram_join.HASHES and 1 - (1 - 0.8**rows) ** bands >= ngram_join.RECALL


def test_clean_documents_with_a_repeated_line_are_kept(spark):
    prose = " ".join(f"the {w} and {w}x of" for w in words(500, 24).split())
    rows = [
        (1, f"Chapter\n{prose}\nChapter", "a"),
        # A table with short lines that come again, below its text.
        (2, f"{prose}\n" + "\n".join(["yes"] * 6 + ["no"] * 6), "a"),
        (3, prose, "a"),
        # The lines that come again are most of the text.
        (4, "\n".join([prose, "the end of it"] * 4), "a"),
    ]
    assert sorted(x.doc_id for x in quality_rules.keep_good(table(spark, rows)).collect()) == [1, 2, 3]


def test_leaks_with_other_numbers_and_names(spark):
    item = "Each day the farmer in the north, Alice, sells 12 kg of apples and 7 kg of pears for 3 dollars, and Alice keeps 12 kg."
    other = item.replace("Alice", "Robert").replace("12", "40").replace("7", "9")
    broken = item.replace("Alice", "Robert").replace("12 kg of apples", "40 kg of apples").replace("keeps 12", "keeps 41")
    # Each value stands for another one everywhere, so nothing that the item says holds here.
    shuffled = "Each day the farmer in the north, Alice, sells 12 kg of apples and 12 kg of pears for 12 dollars, and Bob keeps 9 kg."
    clean = "The river in the south is long and nobody knows how many fish live in it these days."
    bench = spark.createDataFrame([(5, item)], "item_id long, text string")
    docs = table(spark, [(0, f"Some start. {item} An end.", "a"), (1, f"{clean} {other}", "a"), (2, clean, "a"), (3, broken, "a"), (4, shuffled, "a")])
    found = {x.doc_id: x for x in decontaminate.contaminated(docs, bench).collect()}
    assert found[0].contaminated and found[1].contaminated and found[1]["items"] == [5]
    # Only the windows whose slots disagree do not count.
    assert not found[2].contaminated and 0.5 < found[3].coverage < found[1].coverage == 1
    assert found[4].coverage < found[3].coverage
    plan = decontaminate.contaminated(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_license_edits_and_exact_words(spark):
    rows = [
        (0, "Released under the MIT License. UNDER--THE mit license!", "a"), (1, "released undr the MIT licence, see file", "a"),
        (2, "Apache License, Version 1.0", "a"), (3, "under the MPL license", "a"), (4, "CC BY-NC; cc by nd", "a"),
    ]
    found = {x.doc_id: x for x in license_scan.scan_licenses(table(spark, rows)).collect()}
    assert (found[0].n_base, found[0].first_word, found[0].last_word, found[0].labels, found[0].score) == (2, 1, 5, "mit", 1.0)
    assert found[0].n_words == 9
    assert (found[1].n_base, found[1].base_labels, found[1].labels) == (0, "", "mit") and 0.8 < found[1].score < 1
    assert "apache-2" not in found[2].labels and "mit" not in found[3].labels and found[4].labels == "cc-by-nc"


def test_license_score_is_that_of_the_matched_notice_and_counts_words(spark):
    plain = "under the mit license"
    for edited, edits in (("undr the mit licens", 2), ("underr the mit license", 1), ("under the mit licence", 1), (plain, 0)):
        x = license_scan.scan_licenses(table(spark, [(1, "see " * 3 + edited + " now", "a")])).first()
        near = [s for s in x.spans if s["size"] == len(plain)]
        assert x.score >= 1 - edits / len(plain) - 1e-9 and (3, 4, edits) in {(s["first"], s["words"], s["edits"]) for s in near}
        assert abs(x.score - max(1 - s["edits"] / s["size"] for s in x.spans)) < 1e-9
    many = f"{plain}. " * 2000
    x = license_scan.scan_licenses(table(spark, [(1, many, "a")])).first()
    assert (x.n_words, x.n_base, x.first_word, x.last_word) == (8000, 2000, 0, 7996)


def test_seeds_find_all_that_bounded_matching_finds():
    import regex

    r = np.random.default_rng(5)
    for notice in license_scan.NOTICES:
        for _ in range(30):
            text = list(notice.phrase)
            for _ in range(int(r.integers(0, notice.edits + 2))):
                text[int(r.integers(0, len(text)))] = "q"
            padded = f" aa {''.join(text)} bb "
            near = regex.search(rf"(?<= )(?:{notice.phrase}){{e<={notice.edits}}}(?= )", padded)
            exact = all(w in "".join(text).split() for w in notice.exact)
            found = license_scan.find(padded, (notice,))
            if near and exact:
                assert found


def test_token_blocks_round_trip_and_detect_damage():
    r = np.random.default_rng(6)
    ids = (r.zipf(1.2, 50_000) % 50_000).astype("int32")
    freq = token_file.frequencies(np.bincount(ids, minlength=70_000))
    assert int(freq.sum()) == 1 << token_file.BITS
    symbols = np.repeat(np.arange(len(freq), dtype="uint32"), freq)
    for n in (0, 1, 7, 2048, 2049, 50_000):
        data = token_file.encode_block(ids[:n], freq)
        assert (token_file.decode_block(data, freq, symbols) == ids[:n]).all()
    many = np.tile(ids, 7)
    data = token_file.encode_block(many, freq)
    # Each checkpoint can be read alone.
    for point in range(3):
        part = many[point * token_file.STEP : (point + 1) * token_file.STEP]
        assert (token_file.decode_block(data, freq, symbols, point) == part).all()
    broken = data[:-9] + bytes([data[-9] ^ 1]) + data[-8:]
    with pytest.raises((ValueError, IndexError)):
        token_file.decode_block(broken, freq, symbols)


def test_pieces_encode_as_whole_texts(monkeypatch):
    public = pytest.importorskip("public_tokenizers")
    r = np.random.default_rng(8)
    alphabet = list("aZ é ß1٣½'’st ll\n\t\r\x0b\u00a0\u2028\u3000\ufeff数据ñ\u0301🙂\U0001fae8\u200b\u0085_-.!²Ⅷ\x1c\x00")
    special = "<|endoftext|>"
    texts = ["", " ", "it's we'll  two\n\n three ", special, f"a{special} b", "\U0001c000 \u088f \ua7cb x"]
    texts += ["".join(r.choice(alphabet, int(r.integers(1, 60)))) for _ in range(1500)]
    for memo in (token_file.MEMO, 20):
        monkeypatch.setattr(token_file, "MEMO", memo)
        encoder = token_file.Encoder(public.path("byte_bpe_50k.json"))
        assert encoder.by_piece
        for text in texts:
            assert encoder.encode(text).tolist() == encoder.library.encode(text, add_special_tokens=False).ids, repr(text)
    assert not token_file.Encoder(public.path("word_bpe_49k.json")).by_piece


def test_rows_with_one_key_stand_in_the_same_order_in_any_partitioning(spark):
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    docs = table(spark, [(None if i % 3 else 7, words(i, 5 + i % 40), "ab"[i % 2]) for i in range(300)])
    runs = []
    for n in (1, 7):
        file, freq = token_file.write_tokens(docs.repartition(n, "text"), path)
        # Another session has only the stored tables.
        runs.append(sorted(map(tuple, token_file.read_tokens(file, freq).collect()), key=lambda x: x[1]))
    assert runs[0] == runs[1] and runs[0][0][1] == 0


def test_token_file_against_the_tokenizer(spark, odd):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("byte_bpe_50k.json")
    rows = [(i, t, s) for i, (_, t, s) in enumerate(odd)]
    found = sorted(token_file.read_tokens(*token_file.write_tokens(table(spark, rows), path)).collect())
    start, tokenizer = 0, Tokenizer.from_file(path)
    for (i, text, _), x in zip(rows, found):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert tuple(x) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert token_file.read_tokens(*token_file.write_tokens(table(spark, []), path)).count() == 0


def test_archives_round_trip(spark, tmp_path):
    big = "<p>" + "z" * 3000
    rows = [(1, "http://a", big), (2, None, big), (5, "http://c", big), (6, "u", None), (7, "u", ""), (8, "u", "tiny"), (9, "u", "tiny"), (None, "u", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    listed = warc.write_warc(pages, f"file://{tmp_path}/w")
    found = {x.page_id: x for x in warc.read_warc(listed).collect()}
    assert len(found) == len(rows)
    assert {k: (x.record_type, x.refers_to) for k, x in found.items()} == {
        1: ("revisit", 5), 2: ("revisit", 5), 5: ("response", None), 6: ("response", None), 7: ("response", None),
        8: ("response", None), 9: ("response", None), None: ("revisit", 5),
    }
    assert found[1].payload_bytes == len(big) and found[6].payload_bytes == 0
    heads = []
    for path in listed.collect():
        with open(path["path"].removeprefix("file://"), "rb") as stream:
            heads += [warc.parse(x)[0] for x in warc.records(stream)]
    ids = {h["X-Page-Id"]: h["WARC-Record-ID"] for h in heads if "X-Page-Id" in h}
    assert len({h["WARC-Record-ID"] for h in heads}) == len(rows)
    assert {h["WARC-Refers-To"] for h in heads if h["WARC-Type"] == "revisit"} == {ids["5"]}
    assert warc.read_warc(warc.write_warc(pages.limit(0), f"file://{tmp_path}/e")).count() == 0


def test_additive_model_learns_an_interaction():
    r = np.random.default_rng(7)
    x = r.random((4000, len(gam.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype("float64")
    model = gam.fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.9


def test_known_words_are_not_cut_again():
    import public_tokenizers as public

    encoder = token_file.Encoder(public.path("byte_bpe_50k.json"))
    odd = ["  a  b \n c", "x  ", "it's we'LL 's  's", "\x1cfoo \x1dbar 　baz", "naïve ü ① ٣ 漢", "tab\t x\n\n y", "a_b _c __d", "é \U0001f600 x", "  y"]
    for text in odd:
        assert encoder.encode(text).tolist() == encoder.library.encode(text, add_special_tokens=False).ids, repr(text)
    text = "Known words, cut once; known words: read twice."
    ids = encoder.encode(text).tolist()
    cut = []
    encoder.pattern = type("Pattern", (), {"findall": lambda _, piece, old=encoder.pattern: cut.append(piece) or old.findall(piece)})()
    assert encoder.encode(text).tolist() == ids
    assert cut == ["Known"]


def test_many_texts_are_cut_at_once_as_the_library_cuts_each():
    import public_tokenizers as public
    import pyarrow as pa

    r = np.random.default_rng(11)
    encoder = token_file.Encoder(public.path("byte_bpe_50k.json"))
    parts = ["a", "Zs", "'s", "'", "'ll", " '", "1", "!", ".", "-", " ", "  ", "\n", "\n\n", " \n", "\t", "\x0c", "\x00", "\x1c", "\x7f"]
    wide = ["é", "ж", "数据", "“", "́", "½", " ", "  ", "\u0085", "  ", "　", "🙂"]
    odd = ["<|endoftext|>", "\U0001c000", "࢏", " Ɤ"]
    for pool in (parts, parts + wide, parts + wide + odd):
        texts = ["".join(r.choice(pool, int(r.integers(0, 12)))) if i % 50 else None for i in range(2000)]
        # Slices, as a task cuts its batches; white space ends one text where another begins.
        column = pa.array(texts, pa.string())
        found = [x.as_py() for a, n in ((0, 700), (700, 0), (700, 1), (701, 1299)) for x in encoder.encode_all(column.slice(a, n))]
        for text, ids in zip(texts, found, strict=True):
            whole = encoder.library.encode(text or "", add_special_tokens=False).ids
            assert np.frombuffer(ids, encoder.kind).tolist() == whole, repr(text)


def test_a_word_that_many_texts_share_is_looked_up_once():
    import public_tokenizers as public
    import pyarrow as pa

    encoder = token_file.Encoder(public.path("byte_bpe_50k.json"))
    asked = []
    encoder.memo = type("Memo", (dict,), {"get": lambda self, name: asked.append(name) or dict.get(self, name)})()
    encoder.encode_all(pa.array([f"x{i} alpha,\nbeta alpha (gamma)." for i in range(500)]))
    # Also behind a line break or before a mark.
    assert [asked.count(w) for w in (b" alpha", b"beta", b"gamma")] == [1, 1, 1]
    # Texts without a place to cut are not remembered whole.
    encoder.encode_all(pa.array(["数据" * 40 + "。" + "数" * 40, "a " + "é" * 70, "b" * 90]))
    assert max(map(len, encoder.memo)) <= token_file.LONGEST


def test_a_task_encodes_few_and_long_texts_at_once(monkeypatch):
    import public_tokenizers as public
    import pyarrow as pa

    path = public.path("byte_bpe_50k.json")
    monkeypatch.setattr(token_file, "CHUNK", 40)
    monkeypatch.setattr(token_file.TaskContext, "get", staticmethod(lambda: type("Task", (), {"partitionId": lambda self: 3})()))
    texts = ["one two", None, "", "long " * 40, "three", " ", "\n four"]
    batch = pa.RecordBatch.from_arrays([pa.array([5, 6, 7, 8, 9, 10, None], pa.int64()), pa.array(texts)], ["doc_id", "text"])
    rows = [x for b in token_file._tokenise(iter([batch, batch]), path) for x in b.to_pylist()]
    encoder, before = token_file.Encoder(path), 0
    assert len(rows) == 14
    for i, x in enumerate(rows):
        ids = [*encoder.library.encode(texts[i % 7] or "", add_special_tokens=False).ids, 0]
        assert np.frombuffer(x["ids"], encoder.kind).tolist() == ids and x["doc_id"] == batch.column(0)[i % 7].as_py()
        assert (x["n_tokens"], x["part"], x["row"], x["before"]) == (len(ids), 3, i, before)
        before += len(ids)
