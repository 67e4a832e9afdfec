import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell.llm import bpe, chat, cotrain, lines, mixing, rules, substrings, superminhash, toxicity, vectors
from keepwell.llm.common import components
from tests.llm import brute

#: Clashing and spare columns, nulls, empty and blank texts, a repeated row, rows without an id.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, doc string, fp int, component string"


def corpus(seed=3, docs=60):
    rng = random.Random(seed)
    vocabulary = ["w%d" % k for k in range(400)]
    base = [rng.choice(vocabulary) for _ in range(160)]
    passage = [rng.choice(vocabulary) for _ in range(70)]
    rows = []
    for i in range(docs):
        kind = i % 6
        if kind < 2:  # near copies of one text, some of them far apart
            w = [x if rng.random() > 0.004 * (i % 11) else rng.choice(vocabulary) for x in base]
        elif kind == 2:
            w = [rng.choice(vocabulary) for _ in range(30)] + passage + [rng.choice(vocabulary) for _ in range(20)]
        elif kind == 3:
            w = [rng.choice(vocabulary) for _ in range(rng.randint(1, 12))]
        else:
            w = [rng.choice(vocabulary) for _ in range(rng.randint(20, 200))]
        text = " ".join(x + ("\n" if rng.random() < 0.08 else "") for x in w)
        rows.append((i * 3 + 1, text.upper() if kind == 1 and i % 4 == 1 else text))
    rows += [(1000, None), (1001, ""), (1002, " \n\t "), (1003, "a a a a a a " * 30), (1004, rows[0][1]), (1005, "Ünï 😀 <|endoftext|> |x| 7")]
    return rows


@pytest.fixture(scope="module")
def docs():
    return corpus()


def frame(spark, rows):
    full = [(i, t, "en", "s%d" % (i % 3) if i % 7 else None, len(t or ""), "x", 1, "y") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def table(spark, docs):
    return frame(spark, docs)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, *columns):
    return {r[0]: tuple(r[1:]) for r in df.select(df.columns[0], *columns).collect()}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(1, 60), rng.randint(1, 60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 140)] + [(5, 5)]
    u = brute.Union({x for e in edges for x in e})
    for a, b in edges:
        u.link(a, b)
    got = by_id(components(spark.createDataFrame([*edges, (None, 3)], "a long, b long")), "component")
    assert got == {x: (u.find(x),) for x in u.up if any(u.find(y) == u.find(x) for y in u.up if y != x)}


def test_substrings(table, docs):
    got = substrings.remove_repeats(table)
    assert by_id(got, "n_words", "n_removed", "kept_sha256") == brute.repeats(docs, 50)
    short = substrings.remove_repeats(table, words=7)
    assert by_id(short, "n_words", "n_removed", "kept_sha256") == brute.repeats(docs, 7)


def test_substrings_repeated_rows_and_null_ids(spark, docs):
    text = docs[2][1]
    rows = [(1, text), (1, text), (None, text), (2, text)]
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_removed > 0) for r in got) == [(0, False), (1, False), (1, False), (2, True)]


@pytest.mark.parametrize("tile", [1024, 4])
def test_near_duplicates(table, docs, tile, monkeypatch):
    monkeypatch.setattr(superminhash, "TILE_ROWS", tile)
    got = by_id(superminhash.near_duplicates(table), "n_shingles", "component_id", "kept")
    assert got == brute.near(docs)


def test_tiles_find_links_between_components():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.choice(60, 40, replace=False).astype(np.uint64)) for _ in range(40)]
    u, v = brute.Union(range(40)), brute.Union(range(40))
    for i in range(40):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 55 * (80 - both):
                u.link(i, j)
    for i, j in superminhash._tile_links(sets, np.arange(40), np.zeros(40, int), 55):
        v.link(i, j)
    assert [u.find(i) for i in range(40)] == [v.find(i) for i in range(40)]


def test_kept_documents(spark, table, docs):
    rows = [*docs, docs[0], (None, docs[0][1])]
    kept = superminhash.kept_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    expected = sorted(i for i, (_, _, stays) in brute.near(docs).items() if stays)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == expected
    assert kept.filter("doc_id IS NULL").count() == 1


def test_lines(table, docs):
    report = {r.doc_id: r for r in lines.line_report(table).collect()}
    gone = brute.removed_lines(docs)
    for i, text in docs:
        parts = (text or "").split("\n")
        assert list(report[i].removed) == gone.get(i, [])
        if text is not None:
            assert report[i].kept_text == "\n".join(x for k, x in enumerate(parts) if k not in gone.get(i, []))


def test_lines_keep_columns_and_rows(spark, table):
    out = lines.without_repeated_lines(table)
    assert out.columns == table.columns and out.count() == table.count()
    rows = [(1, "same line here"), (1, "same line here"), (None, "same line here"), (2, "same  LINE here\nother")]
    got = lines.without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [
        (0, "same line here"), (1, "same line here"), (1, "same line here"), (2, "other")
    ]


UNSPACED = [
    (2001, "https://www.example.org/a/first-page.html\nhttps://www.other.net/something/else?id=7"),
    (2002, "https://www.example.org/a/first-page.html?x\nこの文章は空白を含まない一つ目の行です\nこの文章は空白を含まない別の話題について"),
    (2003, "QUJD" + "😀".join("%05d" % (k * k) for k in range(400)) + "\nfloccinaucinihilipilification alpha\nfloccinaucination alpha"),
    (2004, "QUJD" + "😀".join("%05d" % (k * k) for k in range(399)) + "\nQUJDREVGR0hJ0123\nQUJDREVGR9999999999\nabc\nabd"),
    (2005, "あ" * 253 + "いろはにほへとちり\n" + "あ" * 256 + "いろ\n" + "".join("%04d" % k for k in range(65))),
]


def test_lines_compare_every_character(spark, docs):
    rows = [*docs, *UNSPACED]
    got = by_id(lines.line_report(frame(spark, rows)), "removed")
    expected = brute.removed_lines(rows)
    assert got == {i: (expected.get(i, []),) for i, _ in rows}


def test_templated_lines(spark):
    """Lines that share most shingles with many others, and are linked with few of them or none."""
    rows = [
        (1, "\n".join(f"line number {n} of the text" for n in range(1500))),
        (2, "\n".join(f"line number {n} of the text" for n in range(1000, 2000))),
        (3, "\n".join(f"entry {n * 7919 % 10007:05d}{n:04d} in the long list of titles of this old catalogue" for n in range(300))),
        (4, "x" * 70_000 + "\n" + "y" * 69_000),
    ]
    got = by_id(lines.line_report(spark.createDataFrame(rows, "doc_id long, text string")), "removed")
    expected = brute.removed_lines(rows)
    assert got == {i: (expected.get(i, []),) for i, _ in rows}


def test_open_lines_are_ordered_in_slices(spark, monkeypatch):
    """No table of whole sets; the shingles are put in order slice by slice, and all that is alike is proposed."""
    sizes = {}

    def counted(df, label, make):
        out = make(df, label)
        sizes.setdefault(label, []).append((out[0] if isinstance(out, tuple) else out).count())
        return out

    for name in ("staged", "written"):
        monkeypatch.setattr(lines, name, lambda df, label, make=getattr(lines, name): counted(df, label, make))
    numbers = [" ".join(f"{(20 * k + j) * 7919 % 10007:05d}" for j in range(20)) for k in range(40)]
    bodies = [f"the list of titles {n} of {x}" for n in numbers for x in ("a fox", "an ox", "so many hens and their chickens")]
    table = spark.createDataFrame([(b,) for b in bodies], "body string").select(F.xxhash64("body").alias("line"), "body")
    number = {r.body: r.line for r in table.collect()}
    got = lines._apart(table.select(F.col("line").alias("rep"), F.col("line").alias("component")), table)
    got = {(r.a, r.b) for r in got.collect()}
    sets = {number[b]: {b[j : j + 9] for j in range(len(b) - 8)} for b in bodies}
    alike = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert alike and alike <= got
    assert len(sizes["prefixes"]) == lines.SLICES and max(sizes["prefixes"]) < 0.6 * sum(sizes["prefixes"])
    assert sorted(sizes) == ["prefix-pairs", "prefixes", "shingle-counts"]


def test_line_shingles(spark):
    bodies = ["a", "12345678", "123456789", "x" * 300, *["".join(chr(0x4E00 + k) for k in range(n)) for n in (256, 257, 264, 265, 512, 513, 2000)]]
    held = spark.createDataFrame([(b,) for b in bodies], "body string").select("body", lines.hashed_shingles(F.col("body")).alias("got"))
    for row in held.collect():
        own = sorted({row.body[j : j + 9] for j in range(max(len(row.body) - 8, 1))})
        hashes = spark.createDataFrame([(x,) for x in own], "x string").select(F.xxhash64("x")).collect()
        assert sorted(row.got) == sorted(h[0] for h in hashes)


def test_bpe_equals_the_library(table, docs):
    tokenizers = pytest.importorskip("tokenizers")
    reference = tokenizers.Tokenizer.from_file(bpe.vocabulary_path())
    got = {r.doc_id: r for r in bpe.encode_decode(table).collect()}
    for i, text in docs:
        ids = reference.encode(text or "", add_special_tokens=False).ids
        assert list(got[i].ids) == ids and got[i].n_tokens == len(ids)
        assert got[i].decoded == reference.decode(ids, skip_special_tokens=False) == (text or "")


def test_bpe_on_odd_strings():
    tokenizers = pytest.importorskip("tokenizers")
    reference = tokenizers.Tokenizer.from_file(bpe.vocabulary_path())
    with open(bpe.vocabulary_path(), encoding="utf-8") as f:
        encoder = bpe.Encoder(bpe.Vocabulary(f.read()))
    rng = random.Random(2)
    letters = [chr(c) for c in [*range(256), *range(0x300, 0x320), 0x2028, 0x3000, 0x4E2D, 0x1F600]] + ["<|endoftext|>", "  ", "'s"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(2000)] + ["aaaa" * 3000]
    ids, at = encoder.encode(texts)
    for k, e in enumerate(reference.encode_batch(texts, add_special_tokens=False)):
        assert ids[at[k] : at[k + 1]].tolist() == e.ids


def test_rules(table, docs):
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    out = rules.quality_verdicts(table)
    assert by_id(out, *columns) == {i: brute.base_counts(t) for i, t in docs}
    assert out.filter("kept AND base_failed").count() == 0


def test_js_distance(spark):
    row = spark.range(1).select(
        rules.js_distance(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(5.0))).alias("apart"),
        rules.js_distance(F.array(F.lit(1.0), F.lit(3.0)), F.array(F.lit(2.0), F.lit(6.0))).alias("same"),
        rules.js_distance(F.array(F.lit(0.0), F.lit(0.0)), F.array(F.lit(2.0), F.lit(6.0))).alias("none"),
    ).first()
    assert row.apart == pytest.approx(1) and row.same == pytest.approx(0) and row.none is None


def test_rules_reject_other_distributions(spark):
    good = [(i, t, "en") for i, t in corpus(5, 60) if t and len(t) > 300]
    odd = [(9001, "ALL UPPER CASE HERE WE GO " * 2 + " ".join("X%dYZ!!" % k for k in range(90)), "en")]
    out = by_id(rules.quality_verdicts(spark.createDataFrame(good + odd, "doc_id long, text string, lang string")), "kept", "class_distance")
    assert out[9001][0] is False and out[9001][1] > rules.MOST_CLASS_DISTANCE


def _verdicts(spark, rows):
    out = rules.quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got, expected = by_id(out, "kept", "class_distance", "word_distance"), brute.verdicts(rows)
    for i, (kept, *distances) in expected.items():
        assert got[i][0] is kept
        assert got[i][1:] == tuple(None if d is None else pytest.approx(d, abs=1e-6) for d in distances)
    return got


GARBAGE = " ".join("XQ%dZ!!%s" % (k * k, "ABCDEFG"[k % 7] * 4) for k in range(14))


def test_rules_judge_a_language_without_common_words(spark):
    rng = random.Random(4)
    rows = [(i, t, "en") for i, t in corpus(5, 30) if t and len(t) > 300]
    for i in range(2000, 2020):  # each sentence is a word of its own
        rows.append((i, " ".join("".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(12)) + "。" for _ in range(60)), "zh"))
    got = _verdicts(spark, [*rows, (3000, GARBAGE, "zh")])
    assert got[3000][0] is False and all(got[i][0] for i in range(2000, 2020))


def test_rules_judge_a_small_language_beside_a_large_one(spark):
    rng = random.Random(6)
    small = [(i, " ".join("".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(20)), "xx") for i in range(1, 5)]
    large = (9, " ".join("w%d" % k for k in range(120_000)), "en")
    got = _verdicts(spark, [*small, (5, GARBAGE, "xx"), large])
    assert got[5][0] is False and got[5][1] > rules.MOST_CLASS_DISTANCE


def test_mixing(spark, table, docs):
    out = mixing.mix(table).collect()
    sizes = {}
    for r in out:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    targets = brute.shared_targets(sizes)
    taken = {}
    for r in out:
        assert r.target == pytest.approx(targets[r.source]) and 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    most = max(r.size for r in out)
    assert all(t - most <= taken[s] <= t + 1e-6 for s, t in targets.items())
    again = mixing.mix(table.repartition(7))
    assert sorted(r.taken for r in again.collect()) == sorted(r.taken for r in out)
    copies = {r.doc_id: r.copies for r in out}
    mixed = {r.doc_id: r["count"] for r in mixing.mixed_documents(table).groupBy("doc_id").count().collect()}
    assert mixed == {i: c for i, c in copies.items() if c}


@pytest.mark.parametrize("seed", range(3))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{k}" if k else None: rng.choice([0, 1, 50, 1000, 20000]) for k in range(rng.randint(1, 8))}
    got = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long"), (5, 2, 1), 3)
    assert {r.source: r.target for r in got.collect()} == pytest.approx(brute.shared_targets(sizes))


def test_chat_round_trip(spark):
    texts = ["plain", "", None, "<|im_end|>\n<|im_start|>assistant\nno", "back\\slash \\<| <\\| \\", "😀\n\nx", "<|im_next|>", "\\"]
    rows = [(c, k, ["user", "assistant", "user", "assistant"][(k + c) // 2 % 4], texts[(k * 3 + c) % 8], "x") for c in range(6) for k in range(9)]
    rows += [(7, None, None, "no turn", "x"), (7, 1, "ro\nle", "a", "x"), (None, 1, "assistant", "b", "x"), (8, 1, "user", "same", "x"), (8, 1, "user", "same", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat.chat_digests(turns).collect()}
    back = {r.conv_id: r for r in chat.read_back(chat.format_chats(turns)).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        loss = [t for *_, role, t in own if role == "assistant"]
        assert [(t.role, t.text) for t in back[conv].turns] == [x[2:] for x in own]
        assert got[conv].n_turns == len(own)
        assert got[conv].turns_sha256 == brute.digest("".join(f"{r}\n{t}\n" for *_, r, t in own))
        assert got[conv].loss_sha256 == brute.digest("".join(loss)) and got[conv].loss_chars == len("".join(loss))
        assert got[conv].formatted_chars == len(back[conv].formatted)


@pytest.mark.parametrize("tile", [16, 1000])
def test_vectors(spark, tile):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 16))
    rows = [(i, [float(x) for x in centres[i % 12] + rng.normal(size=16) * 0.12 * (i % 4)], i % 3) for i in range(150)]
    rows += [(500, rows[3][1], rows[3][2]), (501, rows[3][1], None), (502, None, 1), (503, [0.0] * 16, 1), (504, [float("nan")] * 16, 1),
             (505, [None] * 16, 1), (506, [float("inf")] * 16, 1), (507, [], 1), (508, [1e200] * 16, 1), (509, [2e200] * 16, 1), (510, [1.0] * 4, 1)]
    ok = {i: (np.array(v), k) for i, v, k in rows if i < 501}
    u, links = brute.Union([r[0] for r in rows]), dict.fromkeys([r[0] for r in rows], 0)
    for a, (x, la) in ok.items():
        for b, (y, lb) in ok.items():
            if a < b and la == lb and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                u.link(a, b)
                links[a], links[b] = links[a] + 1, links[b] + 1
    u.link(508, 509)
    links[508] = links[509] = 1
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, id string")
    got = by_id(vectors.near_vectors(df, tile=tile), "n_links", "component_id", "kept")
    assert got == {i: (links[i], u.find(i), u.find(i) == i) for i in links}


def test_quantisation_bound():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 24))
    x /= np.sqrt((x**2).sum(axis=1))[:, None]
    q, s, length, rest = vectors.quantised(x)
    estimate = (q.astype(float) @ q.T.astype(float)) * s[:, None] * s
    bound = length[:, None] * rest + rest[:, None] * (length + rest)
    assert (np.abs(estimate - x @ x.T) <= bound).all() and bound.max() < 0.05


def labelled(spark, seed=11, docs=600):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(docs):
        w = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(rng.randint(30, 80))]
        toxic, good = int(i % 5 == 0), int(i % 7 != 0)
        if toxic:
            w[3:3] = rng.sample(["zzinsult", "zzother", "zzthird"], 2)
        if not good:
            w = [x.upper() + "!!" for x in w]
        rows.append((i, " ".join(w), "en", "s%d" % (i % 4), 0))
        if i % 3:
            labels.append((i, good, toxic))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(
        labels, "doc_id long, quality int, toxic int"
    )


def test_toxicity(spark):
    docs, labels = labelled(spark)
    out = toxicity.score(docs, toxicity.learn(docs, labels)).join(labels, "doc_id").filter("held_out")
    wrong = out.filter("predicted <> toxic").count()
    assert out.count() > 50 and wrong <= 0.03 * out.count()
    odd = toxicity.score(spark.createDataFrame([(1, None), (2, ""), (None, "zz")], "doc_id long, text string"), toxicity.Model({}, np.zeros(0), -5.0))
    assert all(0 < r.score < 0.5 and r.predicted == 0 for r in odd.collect())


def test_cotraining(spark):
    docs, labels = labelled(spark)
    out = cotrain.quality(docs, labels).join(labels, "doc_id").filter("held_out")
    assert out.filter("predicted <> quality").count() <= 0.03 * out.count()
    none = labels.filter("quality > 5")
    assert cotrain.accepted(docs, none).count() == docs.count()
    odd = docs.limit(3).withColumn("text", F.lit(None).cast("string")).withColumn("p_text", F.lit(1))
    assert cotrain.accepted(odd, labels).columns == odd.columns


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert lines.line_report(empty).count() == 0
    assert bpe.encode_decode(empty).count() == 0
    assert toxicity.score(empty, toxicity.learn(empty, labels)).count() == 0
    assert rules.quality_verdicts(empty).count() == 0
    assert cotrain.quality(empty, labels).count() == 0
    assert chat.chat_digests(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    assert substrings.remove_repeats(empty).count() == 0
    assert superminhash.near_duplicates(empty).count() == 0
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def test_common_words_are_looked_up_by_slot(spark):
    """Words that share a slot, words that only share a slot with one, and words of no slot."""
    words = [f"w{k}" for k in range(900)]
    table = spark.createDataFrame([("x", " ".join(words[:200] * 2))], "lang string, text string")
    reference = rules.language_references(table).drop("ref_lang", "ref_classes")
    slots = reference.first()["ref_slots"]
    assert sum(map(len, slots)) == 200 and max(map(len, slots)) > 1
    texts = spark.createDataFrame([(words[150:] + words[150:160],), ([],)], "words array<string>")
    rows = texts.select(F.transform("words", lambda w: F.xxhash64(w)).alias("hashes")).crossJoin(reference)
    got = [r.common for r in rules.common_word_counts(rows, "hashes").collect()]
    full, empty = sorted(got, key=len, reverse=True)
    assert empty == [] and [x["i"] for x in full] == sorted({x["i"] for x in full})
    held = [h for slot in slots for h in slot]
    hash_of = {r.w: r.h for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", F.xxhash64("w").alias("h")).collect()}
    assert {held[x["i"]]: x["n"] for x in full} == {hash_of[w]: 2 if w in words[150:160] else 1 for w in words[150:200]}


def test_lines_that_are_settled_do_not_meet_by_rare_shingles(spark, monkeypatch):
    """Twos that share half of their words, and threes whose third line is like none: no bucket is left open."""
    rng = random.Random(8)
    words = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    rows = []
    for k in range(60):
        common, line = words(14), words(20)
        rows += [(4 * k, common + " " + words(14)), (4 * k + 1, common + " " + words(14))]
        rows += [(4 * k + 2, line), (4 * k + 3, line + " " + words(1) + "\n" + " ".join(line.split()[:10]) + " " + words(10))]
    met, apart = [], lines._apart
    monkeypatch.setattr(lines, "_apart", lambda left, bodies: met.append(left.count()) or apart(left, bodies))
    gone = {r.doc: r.removed for r in lines.removed_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert gone == {4 * k + 3: [0] for k in range(60)}
    assert met == [0]


def test_strays_are_compared_with_all_lines_of_other_components(spark):
    rng = random.Random(9)
    rows = [(key, rep, rng.choice([1, 1, 1, 2, 3])) for key in range(9) for rep in rng.sample(range(100), 12)]
    component = dict({(rep): c for _, rep, c in rows})
    rows = sorted({(key, rep, component[rep]) for key, rep, _ in rows})
    frame = spark.createDataFrame(rows, "key long, rep long, component long")
    largest = lines._largest(frame)
    got = sorted((r.a, r.b) for r in lines._stray_pairs(frame.join(largest, "key")).collect())
    expected = {(x[1], y[1]) for x in rows for y in rows if x[0] == y[0] and x[1] < y[1] and x[2] != y[2]}
    assert got == sorted(expected)
    for r in largest.collect():
        own = [c for key, _, c in rows if key == r.key]
        assert r.strays == len(own) - max(map(own.count, own)) and own.count(r.main) == len(own) - r.strays
