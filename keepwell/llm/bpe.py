"""Byte-level BPE encoding and decoding by batched numpy merge rounds.

The words of many texts are merged together: their symbols lie in one flat array, the ids of
neighbouring symbols make pair keys, and a binary search over the sorted keys of all merges gives
each pair's rank. In every round each word merges all occurrences of its lowest-ranked pair, left to
right. Words that a task has met before are looked up.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm import kernels
from keepwell.llm.common import shipped

VOCABULARY = "byte_bpe_50k.json"

#: How the vocabulary's authors split a text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Words, and characters of words, beyond which a task forgets the words it has met.
_REMEMBERED, _LETTERS = 400_000, 8_000_000
_NEVER = np.iinfo(np.int64).max


def vocabulary_path(folder: str | None = None, name: str = VOCABULARY) -> str:
    """A vocabulary file in a folder, or where the package of public tokenizers keeps it."""
    if folder is not None:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it prints, else one from 256 on."""
    printed = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in printed else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Tables of a byte-level BPE file, a few megabytes of arrays; built on the driver, used in tasks."""

    def __init__(self, content: str):
        spec = json.loads(content)
        ids, merges = spec["model"]["vocab"], spec["model"]["merges"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in merges]
        letters = byte_letters()
        of_letter = {c: b for b, c in enumerate(letters)}
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*ids.values(), *self.specials.values()]) + 1
        self.size = size
        self.of_byte = np.array([ids[c] for c in letters], np.int64)
        pairs = np.array([ids[a] * size + ids[b] for a, b in merges], np.int64)
        order = np.argsort(pairs, kind="stable")
        self.pair_keys, self.ranks = pairs[order], order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in merges], np.int64)[order]
        # All pairs of single bytes, with which every word begins.
        self.byte_ranks, self.byte_results = self._ranked(
            (self.of_byte[:, None] * size + self.of_byte[None, :]).ravel()
        )
        spelled = [b""] * size
        for token, i in ids.items():
            spelled[i] = bytes(of_letter[c] for c in token)
        for token, i in self.specials.items():
            spelled[i] = token.encode()
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_at = np.cumsum([0, *map(len, spelled)])

    @classmethod
    def of(cls, tables: dict) -> Vocabulary:
        """From the tables of another one: a broadcast holds plain arrays, as tasks may not know this class by name."""
        made = cls.__new__(cls)
        made.__dict__.update(tables)
        return made

    def _ranked(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair key; _NEVER where no merge has that pair."""
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.ranks[at], _NEVER), self.merged[at]

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in one array, where each word starts and the last ends)."""
        sizes = np.array([len(w) for w in words], np.int64)
        letters = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.of_byte[letters]
        owner = np.repeat(np.arange(len(words)), sizes)
        # For each symbol, rank and result of its pair with the next; a word's last symbol has none.
        first_pairs = letters[:-1].astype(np.int64) * 256 + letters[1:]
        rank = np.append(self.byte_ranks[first_pairs], _NEVER)
        result = np.append(self.byte_results[first_pairs], 0)
        rank[np.cumsum(sizes) - 1] = _NEVER
        done_symbols, done_owners = [], []
        while len(symbols):
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            best = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(owner))))
            over = best == _NEVER
            if over.any():
                done_symbols.append(symbols[over])
                done_owners.append(owner[over])
                symbols, owner, rank, result, best = (x[~over] for x in (symbols, owner, rank, result, best))
                if not len(symbols):
                    break
            # Of overlapping occurrences (a a a) every second is taken, from the left.
            places = np.flatnonzero(rank == best)
            opens = np.append(True, np.diff(places) > 1)
            run_start = places[opens][np.cumsum(opens) - 1]
            places = places[(places - run_start) % 2 == 0]
            symbols[places] = result[places]
            changed = np.zeros(len(symbols), bool)
            changed[places] = True
            stay = np.ones(len(symbols), bool)
            stay[places + 1] = False
            symbols, owner, rank, result, changed = (x[stay] for x in (symbols, owner, rank, result, changed))
            # Only the pairs on either side of a merge are new.
            changed[:-1] |= changed[1:]
            new = np.flatnonzero(changed)
            last = (new == len(symbols) - 1) | (owner[np.minimum(new + 1, len(owner) - 1)] != owner[new])
            rank[new[last]] = _NEVER
            new = new[~last]
            rank[new], result[new] = self._ranked(symbols[new] * self.size + symbols[new + 1])
        symbols = np.concatenate([symbols, *done_symbols])
        owner = np.concatenate([owner, *done_owners])
        order = np.argsort(owner, kind="stable")
        starts = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.bincount(owner, minlength=len(words)), out=starts[1:])
        return symbols[order], starts

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ids in one array, where each id's bytes start and the last end)."""
        return gathered(self.spelled, self.spelled_at[:-1][ids], self.spelled_at[1:][ids])


def gathered(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices [start, end) of ``flat`` one after the other, and where each begins."""
    lengths = ends - starts
    at = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=at[1:])
    return flat[np.arange(at[-1]) + np.repeat(starts - at[:-1], lengths)], at


class Encoder:
    """Encodes texts, remembering words; what it remembers is bounded."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.findall = regex.compile(PATTERN).findall
        self.uneven = regex.compile(r"(?:^|\s) | (?:\s|$)").search
        specials = sorted(vocabulary.specials, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")").split if specials else None
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.letters = 0
        self.places = {" " + s: k for k, s in enumerate(self.vocabulary.specials)}
        self.flat = np.array(list(self.vocabulary.specials.values()), np.int32)
        self.starts = np.arange(len(self.flat) + 1)

    def units(self, text: str) -> list[str]:
        """Keys of the pieces of a text that can be encoded apart.

        No word goes over a single space between two other characters, so most texts are split there,
        and a key means itself with a space before it. A key that begins with a space means what
        follows that space: a text's first piece, or a word of a text that is split by the pattern.
        """
        special = self.split is not None and any(s in text for s in self.vocabulary.specials)
        if not special and not self.uneven(text):
            keys = text.split(" ")
            keys[0] = " " + keys[0]
            return keys
        pieces = self.split(text) if special else [text]
        # Every second piece is a special token itself.
        return [" " + w for k, piece in enumerate(pieces) for w in ([piece] if k % 2 else self.findall(piece))]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in one array, where each text starts and the last ends)."""
        if len(self.places) > _REMEMBERED or self.letters > _LETTERS:
            self._forget()
        split = [self.units(t) if t else [] for t in texts]
        keys = [k for unit in split for k in unit]
        new = list(set(keys).difference(self.places))
        if new:
            words = [self.findall(k[1:] if k[:1] == " " else " " + k) for k in new]
            ids, starts = self.vocabulary.merge([w.encode() for unit in words for w in unit])
            ends = starts[np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))]
            base = len(self.places)
            self.places.update(zip(new, range(base, base + len(new)), strict=True))
            self.flat = np.concatenate([self.flat, ids.astype(np.int32)])
            self.starts = np.concatenate([self.starts, self.starts[-1] + ends])
            self.letters += sum(map(len, new))
        at = np.fromiter(map(self.places.__getitem__, keys), np.int64, len(keys))
        ids, begins = gathered(self.flat, self.starts[:-1][at], self.starts[1:][at])
        return ids, begins[np.cumsum([0, *map(len, split)])]


def _round_trip(tables):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary.of(tables.value))
        for batch in batches:
            texts = batch.column(0)
            for row, _, offsets in kernels.text_slices(texts, kernels.SLICE_BYTES):
                part = batch.slice(row, len(offsets) - 1)
                ids, at = encoder.encode(part.column(0).fill_null("").to_pylist())
                raw, byte_at = encoder.vocabulary.decode(ids)
                words = ids.astype("<u4")
                digests, decoded, decoded_digests = [], [], []
                for a, b in zip(at[:-1], at[1:], strict=True):
                    digests.append(hashlib.sha256(words[a:b]).hexdigest())
                    # Bytes that are no UTF-8 become replacement characters, as in any decoder.
                    decoded.append(raw[byte_at[a] : byte_at[b]].tobytes().decode("utf-8", "replace"))
                    decoded_digests.append(hashlib.sha256(decoded[-1].encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(1),
                        pa.array(np.diff(at)),
                        pa.array(digests, pa.string()),
                        pa.array(decoded_digests, pa.string()),
                        pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32())),
                        pa.array(decoded, pa.string()),
                    ],
                    names=["doc", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"],
                )

    return run


def encode_decode(
    docs: DataFrame, vocabulary: str | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256, ids, decoded.

    ``vocabulary`` is a byte-level BPE file in JSON, read on the driver and broadcast: its size, not
    the data's. No special tokens are added; those that a text spells out are encoded as such.
    ids_sha256 is over the ids as little-endian unsigned 32-bit integers, decoded is the text that the
    ids give back. Null and empty texts have no ids. Texts of any length are encoded whole; memory is
    bounded by the slice (the text, if that is longer) and the words remembered. Repeated rows give
    repeated results, an empty table none. Other columns are not read.
    """
    spark = docs.sparkSession
    with open(vocabulary or vocabulary_path(), encoding="utf-8") as f:
        tables = spark.sparkContext.broadcast(vars(Vocabulary(f.read())))
    return docs.select(F.col(text).alias("text"), F.col(doc_id).cast("long").alias("doc")).mapInArrow(
        _round_trip(tables),
        "doc long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>, decoded string",
    ).withColumnRenamed("doc", doc_id)


def digests(encoded: DataFrame, *more: str) -> DataFrame:
    """What identifies the outcome, with ``more`` of its columns."""
    return encoded.select(encoded.columns[0], "n_tokens", "ids_sha256", "decoded_sha256", *more)


shipped(__name__)
