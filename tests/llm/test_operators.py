"""Every operator against a plain version, on rows with nulls, copies, long texts and clashing columns, and on none."""

import hashlib
import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from listloom.llm import (
    bpe, components, decontamination, language_model, ngram_join, packing, quality, sharding, textcodes, token_counts,
    toxicity, url_filter, warc,
)
from listloom.llm.common import prepare
from listloom.llm.queries import tokenizer_path

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, mark string, row string, key string, token string, label string, _text string"
VOCABULARY = [f"w{i}" for i in range(60)] + ["Über", "NAÏVE", "the", "of"]


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice(VOCABULARY) + draw.choice(["", "", ",", ".\n"]) for _ in range(n))


def edited(text, seed, n):
    words, draw = text.split(" "), random.Random(seed)
    for _ in range(n):
        words[draw.randrange(len(words))] = f"x{draw.randrange(10**6)}"
    return " ".join(words)


PASSAGE = prose("passage", 24)


def odd_rows():
    """Nulls, empty and blank texts, short ones, repeated rows, ids that come twice, near copies and long texts."""
    base = prose("base", 120)
    texts = [
        None, "", " \t\n\r\x0b\x0c ", "one", "one two", "One TWO three", "a\u00a0b \u2003 c", "<|endoftext|> x<|endoftext|>", "line\nline\n\nline x\nx",
        base, base, base.upper(), *[edited(base, i, 2 + i % 7) for i in range(12)], prose("long", 30_000), " " * 300 + "x" * 5000,
        prose("a", 40) + " " + PASSAGE + " " + prose("b", 40), PASSAGE, PASSAGE.split(" ", 3)[3], "x " + " ".join(PASSAGE.split()[:9]),
    ]
    texts += [prose(i, 5 + i * 3) for i in range(20)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(None, base), (None, None), (9, base), (9, prose("other", 30)), (7, texts[7]), (3, None)]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    prepare(spark)
    rows = odd_rows()
    full = [(k, t, None, None, None, "m", "r", "k", "t", "l", "u") for k, t in rows]
    return rows, spark.createDataFrame(full, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def same_rows(got, wanted):
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, wanted), key=key)


def encoded(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path()).encode(text or "", add_special_tokens=False).ids


def test_word_codes_do_not_depend_on_slices(monkeypatch):
    texts = [t for _, t in odd_rows()]
    column = pa.array(texts, type=pa.string())
    data, offsets = textcodes.text_buffers(column)
    whole = textcodes.words(data, offsets)
    monkeypatch.setattr(textcodes, "SLICE_BYTES", 50)
    cut = textcodes.words(data, offsets)
    assert (whole.codes == cut.codes).all() and (whole.bounds == cut.bounds).all()
    names = [w.encode() for t in texts for w in brute.BLANK_WORDS.findall(brute.lower(t))]
    assert len(names) == len(whole.codes) and len(set(names)) == len(set(whole.codes.tolist())) == len(set(zip(names, whole.codes.tolist())))


def test_fast_ids_are_those_of_the_library():
    draw = random.Random(5)
    parts = ["'s", "don't", " ", "  ", "\n", "\t\n ", "é", "ß", "日本", "🙂", "123", "²", "<|endoftext|>", "_-", "\u00a0", "\u2003x", "\x00", "\u0301"]
    texts = ["".join(draw.choices(parts, k=40)) for _ in range(200)] + [t or "" for _, t in odd_rows()]
    encode = bpe.encoder(tokenizer_path()).ids
    assert all(encode(t).tolist() == encoded(t) for t in texts)
    long = " " * 200_000 + "x y" * 40_000
    assert [encode(p).tolist() for p in bpe.pieces(long, 1000)] and np.concatenate([encode(p) for p in bpe.pieces(long, 1000)]).tolist() == encoded(long)


def test_packing(odd, none):
    rows, docs = odd
    got = packing.pack_documents(docs, tokenizer_path(), group_docs=8).collect()
    wanted = {}
    for k, t in rows:
        ids = np.array([*encoded(t), 1], dtype="<u4")
        for a in range(0, len(ids), 2048):
            part = ids[a : a + 2048]
            piece = (k, a, len(part), zlib.crc32(part), len(ids))
            wanted[piece] = wanted.get(piece, 0) + 1
    same_rows([r[:5] for r in got], [p for p, n in wanted.items() for _ in range(n)])
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack_documents(none, tokenizer_path()).count() == 0


def test_first_fit_decreasing_against_a_scan():
    lengths = np.random.default_rng(3).integers(1, 101, 400)
    bins, offsets = packing.first_fit_decreasing(lengths, 100)
    rooms, place = [], {}
    for i in np.argsort(-lengths, kind="stable"):
        b = next((b for b, room in enumerate(rooms) if room >= lengths[i]), len(rooms))
        if b == len(rooms):
            rooms.append(100)
        place[i] = (b, 100 - rooms[b])
        rooms[b] -= lengths[i]
    assert [place[i] for i in range(len(lengths))] == list(zip(bins.tolist(), offsets.tolist()))


@pytest.mark.parametrize(("rare", "block"), [(32, 256), (2, 3)])
def test_ngram_join(odd, none, monkeypatch, rare, block):
    """Both ways of comparing give all links: pairs of rare n-grams, and blocks of frequent ones."""
    monkeypatch.setattr(ngram_join, "PAIR_CLASSES", rare)
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", block)
    rows, docs = odd
    got = ngram_join.link_documents(docs, ngram_join.Similarity(4, 85)).collect()
    wanted = [(k, *r) for (k, _), r in zip(rows, brute.components(rows, 4, 85))]
    same_rows(got, wanted)
    assert ngram_join.link_documents(none, ngram_join.Similarity(4, 85)).count() == 0


def test_one_of_each_group_stays(odd):
    rows, docs = odd
    kept = ngram_join.keep_one_of_each(docs, ngram_join.Similarity(5, 80))
    assert kept.columns == docs.columns
    found = brute.components(rows, 5, 80)
    alone = {t for (k, t), (n, _) in zip(rows, found) if n == 0}
    left = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert len(left) == len(set(left)) and alone <= {t for _, t in left}
    sizes = dict(zip(rows, found))
    # Ids that come twice name several groups, so a group is told by its id and its kind of text.
    kind = lambda r: (sizes[r][1], len(r[1]) > 300)
    assert sorted(kind(r) for r in left if sizes[r][0]) == sorted({kind(r) for r in rows if sizes[r][0]})


def test_parity_maps_never_overstate_the_difference():
    draw = np.random.default_rng(1)
    for n in (1, 5, 70, 900):
        a = np.unique(draw.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: n - n // 5], draw.integers(0, 1 << 63, n // 3 + 1, dtype=np.uint64)]))
        maps = [ngram_join.parity_maps(np.zeros(len(x), dtype=np.int64), x, np.array([len(x)]))[0] for x in (a, b)]
        assert ngram_join.least_difference(*maps) <= len(np.setxor1d(a, b))


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(3, i) for i in range(10, 40)] + [(5, 3), (7, 7)]
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 3 for i in [3, 5, *range(10, 40)]}}
    assert components.connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_language_model(odd, none):
    rows, docs = odd
    model, wanted = brute.language_scores(rows)
    for u in ("<s>", "the", "w1", "nobody"):
        assert abs(sum(model.p(v, u) for v in model.count) + model.p("nobody", u) - 1) < 1e-9
    got = language_model.score_documents(docs).collect()
    key = lambda r: tuple((v is None, str(v)) for v in r[:5])
    pairs = zip(sorted(got, key=key), sorted([(k, *w) for (k, _), w in zip(rows, wanted)], key=key))
    for g, w in pairs:
        assert tuple(g)[:5] == w[:5]
        assert g["base_score"] == pytest.approx(w[5], rel=1e-9) and g["score"] == pytest.approx(w[6], rel=1e-9)
    assert language_model.score_documents(none).count() == 0


def test_language_model_of_several_shards(odd):
    _, docs = odd
    texts = docs.select("text")
    one, many = language_model.fit(texts), language_model.fit(texts, shard_bytes=1 << 12)
    assert many.vocabulary.shards > 5
    a, b = ({(r["doc_id"], r["n_tokens"], round(r["score"], 6)) for r in language_model.score(docs, m).collect()} for m in (one, many))
    assert a == b


def test_decontamination(spark, odd, none):
    rows, docs = odd
    items = [(1, PASSAGE), (10, " ".join(PASSAGE.split()[5:20])), (2, "One two, THREE"), (None, "w1 w2"), (4, ""), (5, None), (6, PASSAGE)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontamination.contamination_report(docs, benchmark).collect()
    same_rows(got, [(k, *r) for (k, _), r in zip(rows, brute.contamination(rows, items))])
    assert decontamination.contamination_report(none, benchmark).count() == 0
    assert not any(r["contaminated"] for r in decontamination.contamination_report(docs, benchmark.limit(0)).collect())
    clean = decontamination.drop_contaminated(docs, benchmark)
    assert clean.count() == sum(not r[4] for r in brute.contamination(rows, items)) and clean.columns == docs.columns


def test_decontamination_without_a_broadcast(spark, odd, monkeypatch):
    rows, docs = odd
    monkeypatch.setattr(decontamination, "broadcast_if_small", lambda df, **_: df)
    items = [(1, PASSAGE)]
    got = decontamination.contamination_report(docs, spark.createDataFrame(items, "item_id bigint, text string"))
    same_rows(got.collect(), [(k, *r) for (k, _), r in zip(rows, brute.contamination(rows, items))])


RULES = [url_filter.rule(*r) for r in (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))]


def test_url_filter(spark):
    cases = {
        "http://A.Example.ORG/es/x": ("a.example.org", "/es/x", "example.org/es/", "block"), "https://example.org/en/1?x": ("example.org", "/en/1", "example.org/en/1", "block"),
        "x://badexample.org/es/": ("badexample.org", "/es/", "org/", "allow"), "http://a.com/fr/#a": ("a.com", "/fr/", "com/fr/", "allow"),
        "http://a.com?q=/fr/": ("a.com", "", None, None), "http://b.org": ("b.org", "", None, None), "no url": ("", "", None, None), "": ("", "", None, None), "a://b://c/d": ("b:", "//c/d", None, None),
    }
    rows = [(i, u, "h") for i, u in enumerate(cases)] + [(None, None, None), (0, next(iter(cases)), "h")]
    rows += [(100 + i, f"http://good{i}.com/fr/news-{i}", "") for i in range(60)] + [(300 + i, f"http://spam{i}.com/de/cheap-pills-{i}", "") for i in range(60)]
    rows += [(900, "http://good7.net/news-7", ""), (901, "http://spam9.net/cheap-pills-9", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string")
    got = url_filter.filter_urls(pages, RULES).collect()
    assert len(got) == len(rows)
    by_id = {r["page_id"]: r for r in got}
    for i, (host, path, rule, verdict) in enumerate(cases.values()):
        assert (by_id[i]["host"], by_id[i]["path"], by_id[i]["rule"]) == (host, path, rule)
        assert by_id[i]["verdict"] == verdict if verdict else by_id[i]["verdict"] in ("allow", "block")
    assert (by_id[None]["host"], by_id[None]["path"], by_id[None]["rule"]) == ("", "", None)
    assert (by_id[900]["verdict"], by_id[901]["verdict"]) == ("allow", "block")
    assert url_filter.filter_urls(pages.limit(0), RULES).count() == 0


def test_markov_probabilities_sum_to_one():
    texts = [b"abcab", b"abd", b"\xc3\xa4x"]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    row, contexts, symbols = url_filter.grams(data, offsets)
    import pandas as pd

    frames = [pd.DataFrame({"level": k, "code": symbols[k].view(np.int64), "context": contexts[k].view(np.int64)}) for k in range(url_filter.ORDER + 1)]
    counts = pd.concat(frames).groupby(["level", "code", "context"]).size().reset_index(name="n")
    model = url_filter._markov(counts)
    total = 0.0
    for last in range(256):
        trial = np.frombuffer(b"ab" + bytes([last]), dtype=np.uint8)
        r, c, s = url_filter.grams(trial, np.array([0, 3]))
        total += np.exp(model.log_probability(r[2:3] * 0, [x[2:3] for x in c], [x[2:3] for x in s], 1)[0])
    r, c, s = url_filter.grams(np.frombuffer(b"ab", dtype=np.uint8), np.array([0, 2]))
    total += np.exp(model.log_probability(r[2:3] * 0, [x[2:3] for x in c], [x[2:3] for x in s], 1)[0])
    # The padding symbol is the only one left out, with its share of the uniform distribution.
    assert 0.99 < total <= 1 + 1e-9


def test_warc_round_trip(spark, tmp_path):
    big, other = "<p>é</p>\r\n\r\nWARC/1.1\r\n" * 100, "y" * 1500
    rows = [(1, "http://a/1", big), (2, "http://a/2\r\nX: y", big), (3, None, big), (4, "u", "small"), (5, "u", "small"), (6, "u", None), (7, "u", ""), (8, "u", other), (8, "u", other), (9, "u", "z" * 999), (10, "u", "z" * 999), (None, "u", big), (None, "v", "w" * 1000)]
    pages = spark.createDataFrame([(*r, "c") for r in rows], "page_id bigint, url string, html string, record_id string")
    got = warc.archive_pages(pages).collect()
    wanted = []
    for k, _, html in rows:
        raw = (html or "").encode()
        newest = max((i for i, _, h in rows if h == html and i is not None), default=None)
        revisit = len(raw) >= 1000 and k != newest
        wanted.append((k, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", newest if revisit else None))
    same_rows(got, wanted)
    path = str(tmp_path / "w")
    warc.write_archives(pages, path, "2024-01-01T00:00:00Z", file_bytes=1000)
    back = warc.read_archives(spark, path).collect()
    assert {r["payload"] for r in back if r["record_type"] == "response"} == {html or "" for _, _, html in rows}
    assert warc._unzip(b"plain") == b"plain"
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_quality_statistics(odd, none):
    rows, docs = odd
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = quality.text_statistics(docs).select("doc_id", *columns).collect()
    same_rows(got, [(k, *brute.statistics(t)) for k, t in rows])
    assert quality.text_statistics(none).count() == 0


def test_learnt_rules_find_two_kinds_of_junk(spark):
    rows = []
    for i in range(600):
        bad = i % 6
        words = prose(i, 80 + i % 50).replace("\n", " ")
        text = words.replace(" ", "%%% ") if bad == 0 else (words.upper() + "!! ") * 3 if bad == 1 else words
        rows.append((i, text, 0 if bad < 2 else 1))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(0, 1), (None, 0), (9999, 0), (7, None)], "doc_id bigint, quality int")
    judged = {r["doc_id"]: r for r in quality.judge_documents(docs, labels).collect()}
    assert sum(judged[i]["method_kept"] == bool(q) for i, _, q in rows) >= 0.98 * len(rows)
    assert all(judged[i]["kept"] == (judged[i]["method_kept"] and not judged[i]["base_failed"]) for i, _, _ in rows)
    unlabelled = quality.judge_documents(docs.limit(5), labels.limit(0)).collect()
    assert all(r["method_kept"] for r in unlabelled)


def statistics_of_kinds(spark, kinds):
    """One row for each kind: the features are noise below 1, but for those that the kind names."""
    draw = random.Random(11)
    rows = [[{**{f: draw.random() for f in quality.FEATURES}, **kind}[f] for f in quality.FEATURES] for kind in kinds]
    stats = spark.createDataFrame(rows, ", ".join(f"{f} double" for f in quality.FEATURES))
    return stats.withColumn("_n", F.pmod(F.xxhash64(*quality.FEATURES), F.lit(3)))


def test_a_rule_list_is_as_long_as_there_are_kinds_of_junk(spark):
    kinds = [{f: 5.0 + i % 7 / 10} for f in quality.FEATURES for i in range(60)] + [{}] * 900
    labelled = statistics_of_kinds(spark, kinds).withColumn("label", (F.greatest(*quality.FEATURES) < 1).cast("int"))
    rules = quality.learn(labelled)
    kept = labelled.groupBy("label", quality.keep_column(rules).alias("kept")).count().collect()
    assert {(r["label"], r["kept"]) for r in kept} == {(0, False), (1, True)}


def test_a_rule_that_fails_on_held_rows_does_not_end_learning(spark):
    """Rows with many digits are bad where rules are grown and good where they are pruned; rows with many marks are always bad."""
    kinds = [{"digit_share": 5.0 + i % 7 / 10} for i in range(300)] + [{"mark_share": 5.0 + i % 7 / 10} for i in range(60)] + [{}] * 600
    bad = (F.col("mark_share") > 1) | ((F.col("digit_share") > 1) & (F.col("_n") != 0))
    labelled = statistics_of_kinds(spark, kinds).withColumn("label", 1 - bad.cast("int"))
    rejected = labelled.where(~quality.keep_column(quality.learn(labelled)))
    assert rejected.where("mark_share > 1").count() == 60


def test_a_decision_list_is_one_ordered_expression():
    rules = [(quality.Condition("a", True, 1.0), quality.Condition("b", False, 2.0)), (quality.Condition("b", True, 5.0),)]
    text = str(quality.keep_column(rules))
    assert text.count("CASE") == 1 or text.count("CASE WHEN") == 1
    assert text.index("a") < text.rindex("b")


def test_token_counts(odd, none):
    rows, docs = odd
    got = token_counts.count_tokens(docs, tokenizer_path()).collect()
    wanted = [(k, len((t or "").encode()), n := len(encoded(t)), n > 512) for k, t in rows]
    same_rows(got, wanted)
    assert token_counts.count_tokens(none, tokenizer_path()).count() == 0
    pieces = token_counts.count_tokens(docs, tokenizer_path("piece_bpe_32k.model")).collect()
    assert len(pieces) == len(rows)


def test_toxicity_learns_interactions_and_words(spark):
    """Insults are toxic; a word of either half alone is not."""
    draw = random.Random(2)
    rows, labels = [], []
    for i in range(1500):
        words = prose(i, 30).split()
        kind = i % 5
        if kind == 0:
            words.insert(draw.randrange(30), draw.choice(["zidiot", "zmoron,"]))
        if kind in (1, 3):
            words.insert(draw.randrange(30), "awful")
        if kind in (2, 3):
            words.insert(draw.randrange(30), "groupies")
        rows.append((i, " ".join(words)))
        labels.append((i, int(kind in (0, 3))))
    docs = spark.createDataFrame(rows + [(None, None), (None, ""), (5000, None)], "doc_id bigint, text string")
    got = toxicity.score_documents(docs, spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id bigint, toxic int")).collect()
    held = {r["doc_id"]: r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 1500}
    assert set(held) == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    right = sum(held[i]["predicted"] == y for i, y in labels if i in held)
    assert right >= 0.97 * len(held)
    assert len(got) == len(rows) + 3 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    empty = toxicity.score_documents(docs.limit(0), spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert empty.count() == 0


def test_toxicity_learns_pairs_of_words_that_say_nothing_alone(spark):
    """Two words are equally common under both labels and toxic only together; insults are toxic alone."""
    draw = random.Random(5)
    rows, labels = [], []
    for i in range(3000):
        words = prose(f"pair{i}", 30).split()
        kind = i % 6
        # Toxic: 0 and 1. Each of the two words is in half of the toxic and in half of the clean texts.
        added = {0: ["nightfall", "harbour"], 1: ["zidiot"], 2: ["nightfall"], 3: ["harbour"], 4: ["nightfall"], 5: ["harbour"]}[kind]
        for word in added:
            words.insert(draw.randrange(30), word)
        rows.append((i, " ".join(words)))
        labels.append((i, int(kind < 2)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = toxicity.score_documents(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int")).where("held_out").collect()
    right = [r["predicted"] == int(r["doc_id"] % 6 < 2) for r in got]
    assert sum(right) >= 0.97 * len(right)
    for kind in range(6):
        of_kind = [ok for r, ok in zip(got, right, strict=True) if r["doc_id"] % 6 == kind]
        assert sum(of_kind) >= 0.9 * len(of_kind)


def test_toxicity_of_odd_rows(odd, spark):
    rows, docs = odd
    got = toxicity.score_documents(docs, spark.createDataFrame([(1, 0)], "doc_id bigint, toxic int")).collect()
    assert len(got) == len(rows) and not any(r["predicted"] for r in got)


def test_sharding(odd, none):
    rows, docs = odd
    got = sharding.shard_documents(docs, 24).collect()
    raw = lambda t: (t or "").encode()
    same_rows([r[:3] for r in got], [(k, len(raw(t)) + 8, zlib.crc32(raw(t))) for k, t in rows])
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "key" and r["grown_shard"] in (r["shard"], 24) and 0 <= r["shard"] < 24
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    homes = {}
    for r in got:
        homes.setdefault(r["doc_id"], set()).add(r["shard"])
    assert all(len(s) == 1 for s in homes.values())
    assert sharding.shard_documents(none, 24).count() == 0


def test_shards_follow_their_weights_and_few_rows_move(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "doc_id")
    weights = {0: 1.0, 1: 2.0, 2: 1.0}
    placed = sharding.assign_shards(rows, "doc_id", weights, {0: 1.0, 1: 2.0})
    size = {r["shard"]: r["count"] for r in placed.groupBy("shard").count().collect()}
    assert abs(size[1] / 20_000 - 0.5) < 0.02 and abs(size[0] - size[2]) < 600
    assert placed.where("shard <> 2 AND grown_shard <> shard").count() == 0
    numbered = sharding.number_slots(placed, "doc_id", bucket_rows=900)
    checks = numbered.groupBy("shard").agg(F.min("slot"), F.max("slot"), F.count_distinct("slot"), F.count("*")).collect()
    assert all((r[1], r[2] + 1, r[3]) == (0, r[4], r[4]) for r in checks)


def test_rules_from_noise_end_at_once(spark, monkeypatch):
    """Labels that follow no feature give no rule and few tries, however many rows there are."""
    tries = []
    monkeypatch.setattr(quality, "_pruned", lambda *a, kept=quality._pruned: tries.append(1) or kept(*a))
    for n in (400, 3000):
        draw = random.Random(n)
        rows = [(draw.randrange(2), *[draw.randrange(1000) for _ in quality.FEATURES]) for _ in range(n)]
        noise = spark.createDataFrame(rows, ["label", *quality.FEATURES])
        assert quality.learn(noise) == []
    assert len(tries) <= 2


def test_rules_are_as_long_as_they_need_to_be(spark):
    """Bad rows that only five conditions together tell apart."""
    draw = random.Random(9)
    names = list(quality.FEATURES)
    rows = []
    for _ in range(6000):
        values = {f: draw.random() for f in names}
        bad = all(values[f] > 0.35 for f in names[:5])
        rows.append((0 if bad else 1, *values.values()))
    frame = spark.createDataFrame(rows, ["label", *names])
    rules = quality.learn(frame)
    judged = frame.withColumn("kept", quality.keep_column(rules))
    right = judged.where((F.col("label") == 1) == F.col("kept")).count() / 6000
    assert right > 0.97 and max(map(len, rules)) >= 5


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_batches_count_what_single_texts_do(name):
    encoder = bpe.Encoder(tokenizer_path(name))
    batch = ["", "one", prose("x", 3000), " " * 9000 + "x", "<|endoftext|> a", "𝄞é\n\n" * 50, prose("y", 40_000)]
    assert encoder.counts(batch).tolist() == [len(encoder.ids(t)) for t in batch]
    assert encoder.counts([]).tolist() == []


def test_archives_are_files_of_about_one_size(spark, tmp_path):
    pages = spark.range(600).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h/"), F.col("id")).alias("url"), F.repeat(F.col("id").cast("string"), 300).alias("html"))
    path = str(tmp_path / "w")
    warc.write_archives(pages, path, "2024-01-01T00:00:00Z", file_bytes=40_000)
    counts = [r["n"] for r in warc.read_archives(spark, path).groupBy("page_id").count().select(F.col("count").alias("n")).collect()]
    assert counts == [1] * 600
    files = sorted((tmp_path / "w").glob("part-*"))
    records = [sum(1 for _ in warc.parse_archive(warc._unzip(f.read_bytes()))) for f in files]
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0]
    assert len(files) == 1 + total // 40_000 and min(records) > 0 and max(records) < 3 * 600 / len(files)
