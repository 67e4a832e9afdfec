"""Cross-tokenizer alignment by pointer jumping, and corpus-wide counts of the id pairs that it links.

A text is encoded by two tokenizers, A and B, whose tokens both cover the bytes of space + text. Every
token points to its farthest-right overlapping token of the other side; successors are doubled until
they stay, and then every token of a component of overlapping tokens points to the component's terminal
token, whose end is a place where tokens of both sides end. Terminals number the groups.

Neither tokenizer has a token that goes over a single space between two other characters, so a text is
cut there into units, and both its tokens and its groups are those of its units. A task remembers the
units that it has met, aligns all new units of a slice of texts at once, and looks up the rest.

Counting needs every pair's number of documents, which depends on all texts. The first pass writes, per
slice of texts (a chunk), its documents with their linked pairs and one dictionary of the chunk's
distinct pairs with document counts. Dictionaries are summed up over the corpus and handed back to the
chunks that hold the pair, so what is shuffled is a pair once per chunk and never once per link, and
what a task holds is bounded by a chunk. Nothing is broadcast but the two vocabulary files.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm import kernels
from keepwell.llm.bpe import PATTERN, Vocabulary, byte_letters, gathered
from keepwell.llm.common import shipped, staged

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"

#: Texts are aligned in chunks of about so many bytes; a longer text is a chunk of its own.
CHUNK_BYTES = 2 << 20
#: Units, and characters of units, beyond which a task forgets the units it has met.
_REMEMBERED, _LETTERS = 300_000, 6_000_000
#: Pairs that are spelled out at a time.
_PAIRS = 1 << 20
#: New units are encoded so many at a time, as the library returns a list for each.
_ENCODED = 20_000
#: Letters below this one are split into words alike by all versions of Unicode.
_BEYOND_LATIN = "\u0250"

_CUT = regex.compile(r"(?<=\S) (?=\S)")


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY_A), public_tokenizers.path(VOCABULARY_B)


class ByteLevel:
    """Side A: a byte-level BPE file of the tokenizers library; special tokens' strings are plain text."""

    def __init__(self, content: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content.decode())
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        of_letter = {c: b for b, c in enumerate(byte_letters())}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        spelled = [b""] * self.size
        for token, i in vocabulary.items():
            known = all(c in of_letter for c in token)
            spelled[i] = bytes(of_letter[c] for c in token) if known else token.encode()
        self.spelled = spelled
        self.vocabulary = Vocabulary(content.decode())
        self.findall = regex.compile(PATTERN).findall

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of space + unit one after the other, and how many each unit has.

        The library encodes units with other letters than Latin ones, for which its tables of characters
        count; the others are merged together in numpy rounds, as its object for each takes longer.
        """
        latin = np.fromiter((u.isascii() or max(u) < _BEYOND_LATIN for u in units), bool, len(units))
        words = [self.findall(" " + units[k]) for k in np.flatnonzero(latin)]
        ids, starts = self.vocabulary.merge([w.encode() for unit in words for w in unit])
        ends = starts[np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))]
        counts = np.zeros(len(units), np.int64)
        counts[latin] = np.diff(ends, prepend=0)
        if latin.all():
            return ids, counts
        rest = np.flatnonzero(~latin)
        others = self.tokenizer.encode_batch([" " + units[k] for k in rest], add_special_tokens=False)
        counts[rest] = [len(e.ids) for e in others]
        flat = np.concatenate([ids, np.fromiter(chain.from_iterable(e.ids for e in others), np.int64)])
        order = np.concatenate([np.flatnonzero(latin), rest])
        begins = np.empty(len(units), np.int64)
        begins[order] = np.cumsum(counts[order]) - counts[order]
        return gathered(flat, begins, begins + counts)[0], counts


class Pieces:
    """Side B: a sentencepiece model, which puts a space before what it encodes."""

    def __init__(self, content: bytes):
        import sentencepiece

        self.processor = p = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.size = p.get_piece_size()
        self.spelled = [
            bytes([int(p.id_to_piece(i)[1:-1], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace("▁", " ").encode()
            for i in range(self.size)
        ]

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self.processor.encode(units, num_threads=1)
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.int64, int(counts.sum())), counts


def labelled(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every token, from the ends of both sides' tokens over the same bytes.

    A token of A points to the token of B that holds its last byte, if that goes on further, and else
    to itself: there both end. A token of B points to the token of A that holds its last byte.
    """
    n = len(end_a)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    over_a = np.searchsorted(end_b, end_a - 1, side="right")
    over_b = np.searchsorted(end_a, end_b - 1, side="right")
    own = np.arange(n)
    follows = np.concatenate([np.where(end_b[over_a] > end_a, n + over_a, own), over_b])
    while True:
        further = follows[follows]
        if np.array_equal(further, follows):
            break
        follows = further
    number = np.cumsum(follows[:n] == own) - 1
    groups = number[follows]
    return groups[:n], groups[n:]


class _Side:
    """Encoded units of one side: all ids in one array, where each unit starts, and where tokens end."""

    def __init__(self, tokenizer, units: list[str]):
        parts = [tokenizer.encode(units[k : k + _ENCODED]) for k in range(0, len(units), _ENCODED)]
        self.ids, lengths = (np.concatenate(x) for x in zip(*parts, strict=True))
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        self.unit = np.repeat(np.arange(len(units)), lengths)

    def only(self, good: np.ndarray) -> None:
        """Forget the tokens of the other units."""
        stay = good[self.unit]
        self.ids, self.unit = self.ids[stay], self.unit[stay]
        self.starts = np.searchsorted(self.unit, np.arange(len(self.starts)))

    def spell(self, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The bytes of all tokens; sets where tokens end in them."""
        spelled, places = gathered(flat, at[:-1][self.ids], at[1:][self.ids])
        self.ends = places[1:]
        self.unit_ends = places[self.starts[1:]]
        return spelled


def _flat(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their weights."""
    if not len(keys):
        return keys, weights
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(weights, first)


class Aligner:
    """Aligns texts by their units, which it remembers within bounds."""

    def __init__(self, a: bytes, b: bytes):
        self.a, self.b = ByteLevel(a), Pieces(b)
        #: a * width + b is the key of an id pair.
        self.width = self.b.size
        self.pairs = self.a.size * self.width
        self.bytes_a, self.bytes_b = _flat(self.a.spelled), _flat(self.b.spelled)
        self.digits = _flat([str(i).encode() for i in range(max(self.a.size, self.b.size))])
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.letters = 0
        self.numbers = np.zeros((4, 0), np.int64)  # tokens of A, of B, groups, links
        self.good = np.zeros(0, bool)
        self.keys, self.times, self.key_at = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)
        self.shown, self.shown_at = np.zeros(0, np.uint8), np.zeros(1, np.int64)

    def _learn(self, units: list[str]) -> None:
        n = len(units)
        a, b = _Side(self.a, units), _Side(self.b, units)
        wanted, wanted_at = _flat([b" " + u.encode() for u in units])
        good = np.ones(n, bool)
        for side, table in ((a, self.bytes_a), (b, self.bytes_b)):
            spelled = side.spell(*table)
            if not np.array_equal(spelled, wanted) or not np.array_equal(side.unit_ends, wanted_at[1:]):
                begins = np.append(0, side.unit_ends)
                good &= np.fromiter(
                    (
                        np.array_equal(spelled[begins[k] : begins[k + 1]], wanted[wanted_at[k] : wanted_at[k + 1]])
                        for k in range(n)
                    ),
                    bool,
                    n,
                )
        if not good.all():
            for side, table in ((a, self.bytes_a), (b, self.bytes_b)):
                side.only(good)
                side.spell(*table)
        group_a, group_b = labelled(a.ends, b.ends)
        groups = int(group_a[-1]) + 1 if len(group_a) else 0
        of_a, of_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        first_a = np.cumsum(of_a) - of_a
        keys, times, key_at, links = self._pairs_of(a, b, group_a, of_b, n)
        per_unit = np.bincount(a.unit[first_a], minlength=n) if groups else np.zeros(n, np.int64)
        numbers = np.stack([np.diff(a.starts), np.diff(b.starts), per_unit, links])
        shown, shown_at = self._spelled_out(a, b, group_a, group_b, of_a, of_b)

        base = len(self.places)
        self.places.update(zip(units, range(base, base + n), strict=True))
        self.letters += sum(map(len, units))
        self.numbers = np.concatenate([self.numbers, numbers], axis=1)
        self.good = np.concatenate([self.good, good])
        self.keys, self.times = np.concatenate([self.keys, keys]), np.concatenate([self.times, times])
        self.key_at = np.concatenate([self.key_at, self.key_at[-1] + key_at[1:]])
        self.shown = np.concatenate([self.shown, shown])
        self.shown_at = np.concatenate([self.shown_at, self.shown_at[-1] + shown_at[1:]])

    def _pairs_of(self, a: _Side, b: _Side, group_a: np.ndarray, of_b: np.ndarray, n: int):
        """Each unit's distinct pair keys and how often it links them; links per unit."""
        partners = of_b[group_a]
        first_b = (np.cumsum(of_b) - of_b)[group_a]
        before = np.concatenate([[0], np.cumsum(partners)])
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        at = 0
        while at < len(partners):
            # As many tokens of A as have about _PAIRS partners together, one at least.
            stop = max(at + 1, int(np.searchsorted(before, before[at] + _PAIRS, "right")) - 1)
            some = partners[at:stop]
            begin = np.cumsum(some) - some
            other = np.arange(int(some.sum())) + np.repeat(first_b[at:stop] - begin, some)
            whole = np.repeat(a.unit[at:stop] * self.pairs + a.ids[at:stop] * self.width, some) + b.ids[other]
            found.append(_summed(whole, np.ones(len(whole), np.int64)))
            at = stop
        keys, times = _summed(*(np.concatenate(x) for x in zip(*found, strict=True)))
        unit, keys = np.divmod(keys, self.pairs)
        links = np.bincount(a.unit, weights=partners, minlength=n).astype(np.int64)
        return keys, times, np.searchsorted(unit, np.arange(n + 1)), links

    def _spelled_out(self, a: _Side, b: _Side, group_a, group_b, of_a, of_b) -> tuple[np.ndarray, np.ndarray]:
        """Each unit as a1,a2|b1; with a semicolon after every group."""
        digits, at = self.digits
        before_a, before_b = np.cumsum(of_a) - of_a, np.cumsum(of_b) - of_b
        place_a = np.arange(len(a.ids)) + before_b[group_a]
        place_b = np.arange(len(b.ids)) + (before_a + of_a)[group_b]
        ids = np.empty(len(a.ids) + len(b.ids), np.int64)
        mark = np.empty(len(ids), np.uint8)
        unit = np.empty(len(ids), np.int64)
        for side, place, last, end in (
            (a, place_a, before_a + of_a - 1, ord("|")),
            (b, place_b, before_b + of_b - 1, ord(";")),
        ):
            ids[place], unit[place] = side.ids, side.unit
            marks = np.full(len(side.ids), ord(","), np.uint8)
            marks[last] = end
            mark[place] = marks
        lengths = at[1:][ids] - at[:-1][ids] + 1
        flat, begins = gathered(digits, at[:-1][ids], at[1:][ids])
        out = np.empty(int(lengths.sum()), np.uint8)
        ends = np.cumsum(lengths)
        is_mark = np.zeros(len(out), bool)
        is_mark[ends - 1] = True
        out[is_mark], out[~is_mark] = mark, flat
        n = len(a.starts) - 1
        return out, np.concatenate([[0], ends])[np.searchsorted(unit, np.arange(n + 1))]

    def align(self, texts: list[str]):
        """Numbers per text (4 rows), shown groups per text, and (text, key, times) of all linked pairs."""
        if len(self.places) > _REMEMBERED or self.letters > _LETTERS:
            self._forget()
        split = [_CUT.split(t) if t else [] for t in texts]
        units = [u for s in split for u in s]
        new = list(set(units).difference(self.places))
        if new:
            self._learn(new)
        at = np.fromiter(map(self.places.__getitem__, units), np.int64, len(units))
        counts = np.fromiter(map(len, split), np.int64, len(split))
        bounds = np.concatenate([[0], np.cumsum(counts)])
        text = np.repeat(np.arange(len(texts)), counts)
        bad = np.zeros(len(texts), bool)
        bad[text[~self.good[at]]] = True
        if bad.any():
            at, text = at[~bad[text]], text[~bad[text]]
            bounds = np.searchsorted(text, np.arange(len(texts) + 1))
        numbers = np.stack(
            [np.bincount(text, weights=row[at], minlength=len(texts)).astype(np.int64) for row in self.numbers]
        )
        shown, shown_at = gathered(self.shown, self.shown_at[:-1][at], self.shown_at[1:][at])
        # A text's units first, then their pairs.
        whole, often = _summed(text * len(self.places) + at, np.ones(len(at), np.int64))
        owner, unit = np.divmod(whole, len(self.places)) if len(whole) else (whole, whole)
        sizes = self.key_at[1:][unit] - self.key_at[:-1][unit]
        keys, _ = gathered(self.keys, self.key_at[:-1][unit], self.key_at[1:][unit])
        times, _ = gathered(self.times, self.key_at[:-1][unit], self.key_at[1:][unit])
        keys, times = _summed(keys + np.repeat(owner * self.pairs, sizes), times * np.repeat(often, sizes))
        owner, keys = np.divmod(keys, self.pairs)
        return numbers, (shown, shown_at[bounds]), (owner, keys, times)


_WRITTEN = (
    "chunk long, dictionary boolean, doc long, n_a long, n_b long, n_groups long, n_links long, "
    "groups string, keys array<long>, times array<int>"
)


def _aligned(files, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*files.value)
        chunk = TaskContext.get().partitionId() << 32
        names = [field.split()[0] for field in _WRITTEN.split(", ")]
        for batch in batches:
            for row, _, offsets in kernels.text_slices(batch.column(0), CHUNK_BYTES):
                n = len(offsets) - 1
                part = batch.slice(row, n)
                numbers, (shown, at), (owner, keys, times) = aligner.align(part.column(0).fill_null("").to_pylist())
                raw = shown.tobytes()
                texts = [raw[x : max(x, y - 1)] for x, y in zip(at[:-1], at[1:], strict=True)]
                if digests:
                    groups = [hashlib.sha256(t).hexdigest() if t else "" for t in texts]
                else:
                    groups = [t.decode() for t in texts]
                offsets = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, chunk)),
                        pa.array(np.zeros(n, bool)),
                        part.column(1),
                        *[pa.array(x) for x in numbers],
                        pa.array(groups, pa.string()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(times.astype(np.int32))),
                    ],
                    names=names,
                )
                # One row with the chunk's distinct pairs, each with the number of documents that link it.
                distinct, documents = np.unique(keys, return_counts=True)
                whole = pa.array([0, len(distinct)], pa.int32())
                nothing = pa.array([0], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk]),
                        pa.array([True]),
                        *[nothing] * 5,
                        pa.array([""], pa.string()),
                        pa.ListArray.from_arrays(whole, pa.array(distinct)),
                        pa.ListArray.from_arrays(whole, pa.array(documents.astype(np.int32))),
                    ],
                    names=names,
                )
                chunk += 1

    return run


def _looked_up(left: pa.Table, right: pa.Table) -> pa.Table:
    """Documents of a chunk with sums over their links, from the counts of the chunk's pairs."""
    key = right.column("key").to_numpy()
    order = np.argsort(key)
    key = key[order]
    count = right.column("documents").to_numpy()[order]
    best = right.column("best").to_numpy(zero_copy_only=False)[order]
    lists = left.column("keys").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    keys = lists.flatten().to_numpy()
    times = left.column("times").combine_chunks().flatten().to_numpy().astype(np.int64)
    at = np.searchsorted(key, keys)
    owner = np.repeat(np.arange(left.num_rows), sizes)
    n_best, count_sum = (np.zeros(left.num_rows, np.int64) for _ in range(2))
    np.add.at(n_best, owner, np.where(best[at], times, 0))
    np.add.at(count_sum, owner, times * count[at])
    names = ["doc", "n_a", "n_b", "n_groups", "n_links", "groups"]
    return pa.table(
        [*[left.column(c) for c in names], pa.array(n_best), pa.array(count_sum)],
        names=[*names, "n_best", "count_sum"],
    )


def _written(docs: DataFrame, paths: tuple[str, str] | None, doc_id: str, text: str, digests: bool) -> tuple[DataFrame, int]:
    spark = docs.sparkSession
    contents = []
    for path in paths or default_paths():
        with open(path, "rb") as f:
            contents.append(f.read())
    files = spark.sparkContext.broadcast(tuple(contents))
    rows = docs.select(F.col(text).alias("text"), F.col(doc_id).cast("long").alias("doc"))
    width = Pieces(contents[1]).size
    return staged(rows.mapInArrow(_aligned(files, digests), _WRITTEN), "aligned"), width


def _counted(written: DataFrame, width: int) -> DataFrame:
    """(key, documents, best): every linked pair once, summed up over the chunks' dictionaries."""
    entries = written.filter("dictionary").select(F.explode(F.arrays_zip("keys", "times")).alias("e"))
    counts = entries.groupBy(F.col("e.keys").alias("key")).agg(F.sum("e.times").alias("documents"))
    counts = staged(counts.withColumn("a", F.floor(F.col("key") / width).cast("long")), "pair-counts")
    highest = counts.groupBy("a").agg(F.max("documents").alias("highest"))
    best = F.col("documents") == F.col("highest")
    return staged(counts.join(highest, "a").select("key", "documents", best.alias("best")), "pairs")


def pair_table(
    docs: DataFrame, paths: tuple[str, str] | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(a_id, b_id, documents, best): the id pairs that any document links, with the number of those documents;
    best marks the pairs with the highest number of their a_id, ties included."""
    written, width = _written(docs, paths, doc_id, text, True)
    key = F.col("key")
    return _counted(written, width).select(
        F.floor(key / width).cast("long").alias("a_id"), (key % width).alias("b_id"), "documents", "best"
    )


def aligned(
    docs: DataFrame,
    paths: tuple[str, str] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    digests: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    Both sides encode without special tokens, whose strings inside a text are plain text: A the text with
    a space before it, B (which adds the space) the text. Places where tokens of both end cut them into
    groups; every token of A is linked with every token of B in its group. An id pair's count is the
    number of documents, rows with an equal id counting each, that link it; n_best counts the links whose
    pair has the highest count of its id of A, ties included; count_sum adds up the counts over all links.
    ``groups`` is ``a1,a2|b1;a3|b2,b3``, or with ``digests`` its lowercase SHA-256.

    ``paths`` names a byte-level BPE file in JSON and a sentencepiece model, read on the driver.
    A null or empty text, and one whose joined bytes differ from space + text on either side (as where it
    holds U+2581), has no tokens: zeros and '' (undigested). Texts of any length are aligned whole; one
    longer than CHUNK_BYTES is a chunk of its own. Repeated rows are documents of their own, an empty
    table gives an empty one, a null id stays null. Other columns are not read.
    """
    written, width = _written(docs, paths, doc_id, text, digests)
    pairs = _counted(written, width)
    entries = written.filter("dictionary").select(F.col("chunk").alias("of"), F.explode("keys").alias("key"))
    # Both sides are written tables, so that a pair that all chunks hold can be split.
    known = entries.join(pairs, "key")
    found = written.filter("NOT dictionary").drop("dictionary").groupBy("chunk").cogroup(known.groupBy("of"))
    out = found.applyInArrow(
        _looked_up,
        "doc long, n_a long, n_b long, n_groups long, n_links long, groups string, n_best long, count_sum long",
    )
    return out.select(
        F.col("doc").alias(doc_id), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"
    )


def digest_columns(found: DataFrame) -> DataFrame:
    """What the query returns, of ``aligned`` with ``digests``."""
    return found.withColumnRenamed("groups", "groups_sha256")


shipped(__name__)
