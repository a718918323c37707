"""BPE encoding by dynamic programming over prefixes, and decoding."""

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from tokenizers import Tokenizer

from ledgerlake.llm.common import workers_import

# Words and token pairs that a worker remembers; twice as many are held at most.
REMEMBERED = 250_000
NEVER = 1 << 62
# Stands for the end of a word; no byte has this code.
END = "Ā"

# The normalizer and word pattern that ``_PLAIN_WORDS`` restates.
_PLAIN_NORMALIZER = ["NFC", "Replace", "Lowercase"]
_PLAIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
# Characters on which that restatement could differ from the library: everything but
# ASCII, composed Latin letters and general punctuation.
_NOT_PLAIN = re.compile(
    "[^\t-\r\x20-\x7e\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-įı-ſ‐-‧]"
)


def is_plain(text: str) -> bool:
    return _NOT_PLAIN.search(text) is None


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_alphabet() -> dict[str, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    written = {byte: chr(byte) for byte in shown} | {
        byte: chr(256 + place) for place, byte in enumerate(hidden)
    }
    return {character: chr(byte) for byte, character in written.items()}


class Memory(dict):
    """Results of a function for the keys seen last; at most two generations of them."""

    def __init__(self, compute: Callable, size: int = REMEMBERED):
        super().__init__()
        self._compute, self._size, self._older = compute, size, {}

    def __missing__(self, key):
        value = self._older.get(key)
        if value is None:
            value = self._compute(key)
        if len(self) >= self._size:
            self._older = dict(self)
            self.clear()
        self[key] = value
        return value


class Codec:
    """Encoder and decoder of one vocabulary file of the ``tokenizers`` library.

    The file's text handling is kept (special tokens, normalizer, word split); merging
    is done here. For each prefix of a word, exactly one token can end its encoding: a
    token that matches there, that encodes to itself, and that is compatible with the
    last token of the prefix before it. Matches come from an automaton over all tokens.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or spec["decoder"] is not None or model.get("continuing_subword_prefix"):
            raise ValueError(f"not a word BPE without decoder: {path}")
        self._library = Tokenizer.from_file(path)
        self._special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self._cut = re.compile("(" + "|".join(map(re.escape, self._special)) + ")") if self._special else None
        names = [part.get("type") for part in (spec["normalizer"] or {}).get("normalizers", [])]
        splits = [part.get("pattern", {}).get("Regex") for part in spec["pre_tokenizer"].get("pretokenizers", [])]
        self._plain = names == _PLAIN_NORMALIZER and splits[:1] == [_PLAIN_PATTERN]
        self._alphabet = str.maketrans(byte_alphabet())
        self._suffix = model.get("end_of_word_suffix") or ""

        vocabulary = model["vocab"]
        self._numbers = list(range(max([*vocabulary.values(), *self._special.values()]) + 1))
        self.texts = [""] * len(self._numbers)
        for token, number in chain(vocabulary.items(), self._special.items()):
            self.texts[number] = token
        self.digits = list(map(str, self._numbers))

        self._merges: dict[tuple[int, int], int] = {}
        parts: dict[int, tuple[int, int]] = {}
        born: dict[int, int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            stem = left.removesuffix(self._suffix) if self._suffix else left
            made = vocabulary[stem + right] if stem + right in vocabulary else vocabulary[left + right]
            pair = vocabulary[left], vocabulary[right]
            self._merges[pair] = rank
            parts[made], born[made] = pair, rank
        self._rims = {number: self._rim(number, parts, born) for number in vocabulary.values()}
        sound = {number for number in vocabulary.values() if number not in parts}
        for number in sorted(parts, key=born.__getitem__):
            left, right = parts[number]
            if left in sound and right in sound and self._meet(left, right, born[number]):
                sound.add(number)
        self._matches = ahocorasick.Automaton()
        for token, number in vocabulary.items():
            if number in sound:
                spelled = self._spell(token)
                self._matches.add_word(spelled, (number, len(spelled)))
        self._matches.make_automaton()
        self._pairs = Memory(lambda pair: self._meet(*pair))
        self._words = Memory(self._encode_word)
        self._chunks = Memory(self._encode_chunk)

    def _spell(self, token: str) -> str:
        """A token as its bytes, one character each, and the end mark."""
        if self._suffix and token.endswith(self._suffix):
            return token.removesuffix(self._suffix).translate(self._alphabet) + END
        return token.translate(self._alphabet)

    @staticmethod
    def _rim(number: int, parts: dict, born: dict) -> tuple[tuple, tuple]:
        """The nodes at both edges of a token's merge tree, innermost first.

        Each comes with the rank at which it is merged into its parent.
        """
        rims = []
        for side in (0, 1):
            node, until, rim = number, NEVER, []
            while True:
                rim.append((node, until))
                if node not in parts:
                    break
                until, node = born[node], parts[node][side]
            rims.append(tuple(reversed(rim)))
        return tuple(rims)

    def _meet(self, left: int, right: int, allowed: int = NEVER) -> bool:
        """Whether two tokens side by side stay apart while both are merged.

        Follows the node at the left token's right edge and the one at the right token's
        left edge as they grow. The two merge with each other if their rank is lower than
        that of the next merge on either side; on the left an equal rank comes first,
        since merging goes from left to right. ``allowed`` is the rank of the merge that
        makes one token of both, when asked whether that token encodes to itself.
        """
        inner, outer = self._rims[left][1], self._rims[right][0]
        at = to = 0
        while True:
            (a, a_until), (b, b_until) = inner[at], outer[to]
            rank = self._merges.get((a, b), NEVER)
            if a_until == b_until == NEVER:
                return rank == allowed
            if rank < a_until and rank <= b_until:
                return False
            if a_until <= b_until:
                at += 1
            else:
                to += 1

    def _encode_word(self, word: str) -> tuple[int, ...]:
        """Ids of one word, spelled as bytes: last token of every prefix, then back."""
        spelled = word + END if self._suffix else word
        last = [-1] * (len(spelled) + 1)
        start = [0] * (len(spelled) + 1)
        pairs = self._pairs
        for stop, (number, size) in self._matches.iter(spelled):
            stop += 1
            if last[stop] >= 0:
                continue
            begin = stop - size
            if begin == 0 or (last[begin] >= 0 and pairs[last[begin], number]):
                last[stop], start[stop] = number, begin
        found = []
        stop = len(spelled)
        while stop:
            found.append(self._numbers[last[stop]])
            stop = start[stop]
        return tuple(reversed(found))

    def _encode_chunk(self, chunk: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(
            self._words[word.encode().decode("latin-1")] for word in _PLAIN_WORDS.findall(chunk)
        ))

    def _encode_segment(self, text: str) -> list[int]:
        """Text without special tokens. No word crosses a blank."""
        if self._plain and is_plain(text):
            return list(chain.from_iterable(map(self._chunks.__getitem__, text.lower().split())))
        if self._library.normalizer is not None:
            text = self._library.normalizer.normalize_str(text)
        return list(chain.from_iterable(
            self._words[word.translate(self._alphabet)]
            for word, _ in self._library.pre_tokenizer.pre_tokenize_str(text)
        ))

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text; null has none."""
        if not text:
            return []
        if self._cut is None or not any(token in text for token in self._special):
            return self._encode_segment(text)
        ids: list[int] = []
        for piece in self._cut.split(text):
            if piece in self._special:
                ids.append(self._special[piece])
            elif piece:
                ids.extend(self._encode_segment(piece))
        return ids

    def decode(self, ids: list[int]) -> str:
        """Text of ids, special tokens shown: without a decoder, tokens and blanks."""
        return " ".join(map(self.texts.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker and file, with what it remembers."""
    return Codec(path)


def encoder(path: str) -> Callable[[Column], Column]:
    """A column function ``text -> array<int>`` of ids."""

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(path)
        for texts in batches:
            yield pd.Series([np.array(own.encode(text), np.int32) for text in texts])

    return encode


def decoder(path: str) -> Callable[[Column], Column]:
    """A column function ``array<int> -> text``; null stays null."""

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(path)
        for rows in batches:
            yield pd.Series([None if ids is None else own.decode(ids.tolist()) for ids in rows], dtype=object)

    return decode


def digester(path: str, with_ids: bool = False) -> Callable[[Column], Column]:
    """``text -> struct<n_tokens, ids_sha256, decoded_sha256[, ids]>``: there and back."""
    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    @F.pandas_udf(fields)
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = codec(path)
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        for texts in batches:
            rows = []
            for text in texts:
                ids = own.encode(text)
                row = [len(ids), sha(" ".join(map(own.digits.__getitem__, ids))), sha(own.decode(ids))]
                rows.append([*row, np.array(ids, np.int32)] if with_ids else row)
            names = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
            yield pd.DataFrame(rows, columns=names)

    return digest


def encode_documents(docs: DataFrame, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if asked, ``ids``.

    One row per row: repeated rows, null ids and null or empty texts (no ids) included.
    Nothing shuffles; a worker holds one Arrow batch and a bounded memory of words.
    Columns other than ``doc_id`` and ``text`` are not looked at.
    """
    workers_import(docs.sparkSession)
    digest = digester(path or default_tokenizer(), with_ids)
    rows = docs.select("doc_id", digest(F.col("text")).alias("d"))
    names = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
    return rows.select("doc_id", *(F.col("d")[name].alias(name) for name in names))
