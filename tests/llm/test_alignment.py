import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from keepwell.llm import alignment
from keepwell.llm.alignment import Aligner, default_paths, labelled

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def aligner():
    return Aligner(*[open(p, "rb").read() for p in default_paths()])


@pytest.fixture(scope="module")
def whole(aligner):
    """A text's (n_a, n_b, n_groups, n_links), shown groups and linked pairs, by the libraries on whole texts."""
    a, b = default_paths()
    left = tokenizers.Tokenizer.from_file(a)
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=b)

    def align(text):
        nothing = ((0, 0, 0, 0), "", Counter())
        if not text:
            return nothing
        ids = left.encode(" " + text, add_special_tokens=False).ids, right.encode(text)
        spelled = [[side.spelled[i] for i in x] for side, x in zip((aligner.a, aligner.b), ids, strict=True)]
        if any(b"".join(s) != (" " + text).encode() for s in spelled):
            return nothing
        ends = [np.cumsum([len(x) for x in s]).tolist() for s in spelled]
        shown, pairs, at = [], Counter(), [0, 0]
        for end in sorted(set(ends[0]) & set(ends[1])):
            group = []
            for k in (0, 1):
                stop = ends[k].index(end) + 1
                group.append(ids[k][at[k] : stop])
                at[k] = stop
            shown.append("|".join(",".join(map(str, g)) for g in group))
            pairs.update((x, y) for x in group[0] for y in group[1])
        return (len(ids[0]), len(ids[1]), len(shown), sum(pairs.values())), ";".join(shown), pairs

    return align


def texts():
    rng = random.Random(4)
    letters = [*"ab c 's\n\t  é日本🙂<>|.,12%", "\x00", "\xa0", "\x85", "\x1c", "　", "endoftext", "<|endoftext|>", " the", " and"]
    out = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(600)]
    return [*out, None, "", " ", "▁", "a ▁ b", "<s> x </s> <0x41>", "  lead", "trail  ", "a" * 5000, "日本" * 700, "x " * 9000, out[0], out[0]]


def test_units_equal_whole_texts(aligner, whole):
    held = [t or "" for t in texts()]
    for part in (held, held[:50]):  # again, from what is remembered
        numbers, (shown, at), (owner, keys, times) = aligner.align(part)
        raw, of = shown.tobytes(), np.searchsorted(owner, np.arange(len(part) + 1))
        for k, text in enumerate(part):
            n, groups, pairs = whole(text)
            assert tuple(numbers[:, k]) == n, text
            assert raw[at[k] : max(at[k], at[k + 1] - 1)].decode() == groups
            found = {divmod(int(x), aligner.width): int(y) for x, y in zip(keys[of[k] : of[k + 1]], times[of[k] : of[k + 1]], strict=True)}
            assert found == pairs


@pytest.mark.parametrize("chunk", [4 << 20, 300])
def test_corpus_counts(spark, whole, chunk, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_BYTES", chunk)
    rows = [(k // 2 if k < 6 else k, t, "x", 1) for k, t in enumerate(texts())] + [(None, "no id here", "x", 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, chunk string, keys int").repartition(4)
    got = alignment.aligned(table).collect()
    per_row = [(i, *whole(t)) for i, t, _, _ in rows]
    documents = Counter(p for *_, pairs in per_row for p in pairs)
    highest = {}
    for (a, _), n in documents.items():
        highest[a] = max(highest.get(a, 0), n)
    expected = [
        (i if i is not None else -1, *n, sum(c for p, c in pairs.items() if documents[p] == highest[p[0]]),
         sum(c * documents[p] for p, c in pairs.items()), groups)
        for i, n, groups, pairs in per_row
    ]
    assert sorted((r.doc_id if r.doc_id is not None else -1, *r[1:]) for r in got) == sorted(expected)
    digested = alignment.digest_columns(alignment.aligned(table, digests=True)).collect()
    assert sorted(r.groups_sha256 for r in digested) == sorted(sha256(g.encode()).hexdigest() if g else "" for *_, g in expected)
    pairs = {(r.a_id, r.b_id): (r.documents, r.best) for r in alignment.pair_table(table).collect()}
    assert pairs == {p: (n, n == highest[p[0]]) for p, n in documents.items()}
    assert alignment.aligned(table.limit(0)).collect() == []


def test_long_components():
    """Components that only come to an end after very many tokens."""
    a, b = np.arange(2, 20_001, 2), np.append(np.arange(3, 20_000, 2), 20_000)
    left, right = labelled(a, b)
    assert set(left) == set(right) == {0}
    left, right = labelled(np.arange(1, 5001), np.arange(5, 5001, 5))
    assert (left == np.arange(5000) // 5).all() and (right == np.arange(1000)).all()
