"""Token-id output: sharded files in which Re-Pair grammars shorten the ids.

A shard is one row of a Parquet table. Its binary fields are little-endian arrays:

========== ============================================================================
``rules``   ``n_rules`` pairs of symbols; rule r is symbol ``base + r``
``symbols`` the shortened ids of all documents
``stops``   index after the last symbol of each document, 4 bytes each
``sizes``   ids of each document, 4 bytes each
========== ============================================================================

A symbol has 2 or 4 bytes if ``width`` says so. From 17 on, ``width`` is in bits: the low
two bytes of all symbols come first, then a plane for each further bit, eight symbols to
a byte. ``doc_ids`` names the documents in order; ``part`` and ``shard`` order the rows.
"""

import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from ledgerlake.llm.bpe import Memory, byte_alphabet, is_plain
from ledgerlake.llm.common import workers_import
from ledgerlake.session import shared_path

END_ID = 2
# Ids after which a shard is closed; it then ends with the document it is in.
SHARD_IDS = 1 << 20
# A pair is frequent from this many places of its shard on: every pair that repeats.
MIN_PAIRS = 2
# Pieces of text of which a worker remembers the ids, about 55 bytes each, and the words
# of longer pieces.
REMEMBERED_PIECES = 1 << 20
REMEMBERED = 300_000
# Characters that are encoded together.
GROUP_CHARS = 1 << 22

# The byte-level word split, restated for texts on which Python's character classes
# agree with the library's (``is_plain``).
_WORDS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
)
_LETTER, _SPACE, _ODD = 1, 2, 4
# What each character is, up to the last plain one; all later ones are odd.
_KINDS = np.array([
    _LETTER * bool(re.match(r"[^\W\d_]", char)) + _SPACE * char.isspace() if is_plain(char) else _ODD
    for char in map(chr, range(0x2029))
], np.uint8)
# Four little-endian bytes an id, for words of few ids.
_PACKERS = [struct.Struct(f"<{number}I").pack for number in range(32)]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _spans(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``values[start:start + size]`` of each start and size, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(values)) < 1 << 31 else np.int64
    source = np.repeat((starts - ends + sizes).astype(kind), sizes)
    source += np.arange(total, dtype=kind)
    return values[source]


def _kinds(data: np.ndarray) -> np.ndarray:
    """``_KINDS`` of the character that each byte of UTF-8 belongs to."""
    kinds = _KINDS[data]
    wide = np.flatnonzero(data >= 0x80)
    if len(wide):
        heads = data[wide] >= 0xC0
        at = wide[heads]
        first, second, third = (
            data[np.minimum(at + step, len(data) - 1)].astype(np.int32) for step in range(3)
        )
        codes = np.where(
            first < 0xE0, (first & 31) << 6 | second & 63,
            (first & 31) << 12 | (second & 63) << 6 | third & 63,
        )
        # Four bytes give at least 0x10000 here.
        found = _KINDS[np.minimum(codes, len(_KINDS) - 1)]
        kinds[wide] = found[np.cumsum(heads) - 1]
    return kinds


class WordIds:
    """Ids of the words met lately, by word.

    Words of at most 16 bytes are remembered as numbers, in columns sorted by a hash; a
    word counts as known only if its bytes are equal too. When ``size`` words are
    exceeded, those not met again since the last time are forgotten.
    """

    WIDTH = 16

    def __init__(self, compute: Callable[[str], bytes], size: int = REMEMBERED_PIECES):
        self._compute, self._size = compute, size
        self._clear()

    def _clear(self) -> None:
        # Hash, both halves of the word, where its ids start, how many they are.
        self._table = np.zeros((5, 0), np.uint64)
        self._ids = np.zeros(0, np.uint32)
        self._met = np.zeros(0, bool)

    def __len__(self) -> int:
        return len(self._met)

    def find(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each of the distinct words, and all their ids in order."""
        _, offsets, data = words.buffers()
        offsets = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1]
        data = np.frombuffer(data, np.uint8)
        lengths = np.diff(offsets)
        short = lengths <= self.WIDTH
        steps = np.arange(self.WIDTH)
        letters = data[np.minimum(offsets[:-1, None] + steps, len(data) - 1)]
        letters[steps >= lengths[:, None]] = 0  # no plain text holds a zero byte
        low, high = letters.view("<u8").T
        hashes = (low ^ high * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0x9E3779B97F4A7C15)
        hashes ^= hashes >> np.uint64(29)
        at = np.searchsorted(self._table[0], hashes)
        hit = short & (at < len(self))
        place = at[hit]
        hit[hit] = (
            (self._table[0, place] == hashes[hit]) & (self._table[1, place] == low[hit])
            & (self._table[2, place] == high[hit])
        )
        self._met[at[hit]] = True
        missing = np.flatnonzero(~hit)
        made = [self._compute(word.decode()) for word in words.take(pa.array(missing)).to_pylist()]
        starts, sizes = np.zeros((2, len(words)), np.int64)
        starts[hit], sizes[hit] = self._table[3:, at[hit]]
        sizes[missing] = np.fromiter(map(len, made), np.int64, len(made)) // 4
        starts[missing] = len(self._ids) + np.cumsum(sizes[missing]) - sizes[missing]
        values = np.concatenate((self._ids, np.frombuffer(b"".join(made), "<u4")))
        ids = _spans(values, starts, sizes)
        new = missing[short[missing]]
        new = new[np.argsort(hashes[new])]
        rows = np.stack((hashes[new], low[new], high[new], sizes[new].astype(np.uint64)))
        self._remember(rows, _spans(values, starts[new], sizes[new]))
        return sizes, ids

    def _remember(self, rows: np.ndarray, ids: np.ndarray) -> None:
        """Adds words by ascending hash: hash, halves and number of ids, and their ids."""
        if len(self) + rows.shape[1] > self._size:
            if 2 * np.count_nonzero(self._met) > self._size:
                self._clear()
            kept = self._table[:, self._met]
            self._ids = _spans(self._ids, kept[3].astype(np.int64), kept[4].astype(np.int64))
            kept[3] = np.cumsum(kept[4]) - kept[4]
            self._table, self._met = kept, np.zeros(kept.shape[1], bool)
        sizes = rows[3]
        starts = np.cumsum(sizes) - sizes + np.uint64(len(self._ids))
        places = np.searchsorted(self._table[0], rows[0])
        self._table = np.insert(self._table, places, np.stack((*rows[:3], starts, sizes)), axis=1)
        self._met = np.insert(self._met, places, True)
        self._ids = np.concatenate((self._ids, ids))


class PieceEncoder:
    """Whole-text encoding that remembers what the library gives for a word.

    Texts are cut where the word split always cuts: before a blank unless it stands
    between two others, after letters, and after a single line end or tab before other
    text. A piece that was not seen lately is split into words, and the library merges the
    words that were not seen lately. Texts with a special token or unusual characters go to the library in one piece.
    """

    def __init__(self, path: str):
        self._library = Tokenizer.from_file(path)
        self._merge = self._library.model.tokenize
        self._special = [token.content for token in self._library.get_added_tokens_decoder().values()]
        self._written = {ord(byte): shown for shown, byte in byte_alphabet().items()}
        self._words = Memory(self._encode_word, REMEMBERED)
        self._pieces = WordIds(self._encode_piece)
        self._blank = self._written[ord(" ")]
        self.size = self._library.get_vocab_size()

    def _encode_word(self, word: str) -> bytes:
        return self._merged(word.encode().decode("latin-1").translate(self._written))

    def _merged(self, written: str) -> bytes:
        ids = [token.id for token in self._merge(written)]
        return _PACKERS[len(ids)](*ids) if len(ids) < len(_PACKERS) else struct.pack(f"<{len(ids)}I", *ids)

    def _encode_piece(self, piece: str) -> bytes:
        # A short word is remembered as a piece; ASCII letters are written as they are.
        if len(piece) <= WordIds.WIDTH and piece[0] == " " and piece.isascii() and piece[1:].isalpha():
            return self._merged(self._blank + piece[1:])
        words = _WORDS.findall(piece)
        if len(words) == 1 and len(piece.encode()) <= WordIds.WIDTH:
            return self._encode_word(piece)
        return b"".join(map(self._words.__getitem__, words))

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of one whole text; null has none."""
        return self.encode_all([text])[0]

    def _encode_odd(self, text: str) -> np.ndarray:
        if is_plain(text) and not any(token in text for token in self._special):
            return np.frombuffer(self._encode_piece(text), "<u4")
        return np.array(self._library.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text. Ordinary texts are cut together, each distinct piece is looked
        up once, and the ids are put in place by array arithmetic."""
        found = [np.zeros(0, np.uint32)] * len(texts)
        filled = [place for place, text in enumerate(texts) if text]
        while filled:
            whole = pa.array([texts[place] for place in filled], pa.large_string())
            offsets = np.frombuffer(whole.buffers()[1], np.int64)[:len(filled) + 1]
            data = np.frombuffer(whole.buffers()[2], np.uint8)[:offsets[-1]]
            kinds = _kinds(data)
            odd = self._odd(data, kinds, offsets, texts, filled)
            if not odd:
                break
            for place in odd:
                found[place] = self._encode_odd(texts[place])
            filled = sorted(set(filled) - odd)
        if filled:
            space, letter = kinds == _SPACE, kinds == _LETTER
            cut = data == 32
            cut[1:] |= letter[:-1] & ~letter[1:]
            # One line end or tab between other characters is a word of its own.
            cut[2:] |= (data[1:-1] < 32) & ~space[2:] & ~space[:-2]
            cut[offsets[:-1]] = True
            begins = np.flatnonzero(cut)
            pieces = pa.Array.from_buffers(pa.large_binary(), len(begins), [
                None, pa.py_buffer(np.append(begins, len(data))), whole.buffers()[2],
            ]).dictionary_encode()
            sizes, ids = self._pieces.find(pieces.dictionary)
            at = pieces.indices.to_numpy()
            result = _spans(ids, (np.cumsum(sizes) - sizes)[at], sizes[at])
            ends = np.concatenate(([0], np.cumsum(sizes[at])))
            edges = ends[np.searchsorted(begins, offsets[1:-1])]
            for place, one in zip(filled, np.split(result, edges)):
                found[place] = one
        return found

    def _odd(
        self, data: np.ndarray, kinds: np.ndarray, offsets: np.ndarray, texts: list, filled: list
    ) -> set[int]:
        """Places of the texts that cannot be cut: unusual characters, a blank between two
        others, special tokens."""
        space = kinds == _SPACE
        at = np.concatenate((
            np.flatnonzero(kinds == _ODD),
            np.flatnonzero((data[1:-1] == 32) & space[:-2] & space[2:]) + 1,
        ))
        rows = np.unique(np.searchsorted(offsets, at, "right") - 1)
        odd = {filled[row] for row in rows.tolist()}
        joined = data.tobytes()
        for token in self._special:
            if token.encode() in joined:
                odd.update(place for place in filled if token in texts[place])
        return odd


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def _by_pair(
    left: np.ndarray, right: np.ndarray, places: np.ndarray, side: int, low: int
) -> tuple[np.ndarray, np.ndarray]:
    """``left << 32 | right`` of all places in ascending order, and the place of each.

    Symbols have ``side`` bits and places ``low``: pair and place are sorted as one number
    where they fit 63 bits.
    """
    pairs = left.astype(np.int64)
    if 2 * side + low > 63:
        pairs <<= 32
        pairs |= right
        order = np.argsort(pairs)
        return pairs[order], places[order]
    pairs <<= side
    pairs |= right
    pairs <<= low
    pairs |= places
    pairs.sort()
    places = pairs & (1 << low) - 1
    pairs >>= low
    right = pairs & (1 << side) - 1
    pairs >>= side
    pairs <<= 32
    pairs |= right
    return pairs, places


def _frequent(
    left: np.ndarray, right: np.ndarray, places: np.ndarray, after: np.ndarray,
    side: int, low: int, min_pairs: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of frequent pairs and their ranks by weight, the pairs by rank, and the places
    of rare ones. ``after`` has the place that follows each."""
    # A symbol that repeats gives a run of one pair: only every other place counts.
    same = np.flatnonzero(left == right)
    opens = np.ones(len(same), bool)
    opens[1:] = places[same[1:]] != after[same[:-1]]
    if not opens.all():
        start = np.flatnonzero(opens)[np.cumsum(opens) - 1]
        keep = np.ones(len(places), bool)
        keep[same[(np.arange(len(same)) - start) % 2 == 1]] = False
        kept = np.flatnonzero(keep)
        left, right, places = left.take(kept), right.take(kept), places.take(kept)
    pairs, places = _by_pair(left, right, places, side, low)
    heads = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1])))
    counts = np.diff(np.append(heads, len(pairs)))
    often = counts >= min_pairs
    hit = np.repeat(often, counts)
    keys, counts = pairs[heads[often]], counts[often]
    by_weight = np.argsort(counts << 30 | (keys * 0x9E3779B97F4A7C1 >> 20) & (1 << 30) - 1)
    rank = np.empty(len(keys), np.int32)
    rank[by_weight] = np.arange(1, len(keys) + 1)
    return places[hit], np.repeat(rank, counts), keys[by_weight], places[~hit]


def re_pair(
    ids: np.ndarray, stops: np.ndarray, base: int, min_pairs: int = MIN_PAIRS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rules, shortened symbols and stops of a shard.

    Each round counts the adjacent pairs inside documents, gives the frequent ones a symbol
    and replaces them; where replacements would overlap, the more frequent pair goes first
    and of equally frequent ones that with the larger hash, so that a chain of ties falls
    apart in few rounds. It ends when no pair is frequent. A pair that loses so many places
    that fewer than ``min_pairs`` are left gets no rule this time.

    A pair that was rare can only become frequent where one of its symbols is new, so later
    rounds look at the places next to replaced ones and at pairs that are still frequent.
    While these are many, the symbols left close ranks after each round; then they stay
    where they are and know their neighbours, and a round's work follows its places.
    """
    min_pairs = max(min_pairs, 2)
    # Each rule takes a symbol away at least, so none is numbered above this.
    symbols = ids.astype(np.int32 if base + len(ids) < 1 << 31 else np.int64)
    last = np.zeros(len(symbols), bool)
    last[stops[stops > np.concatenate(([0], stops[:-1]))] - 1] = True
    rules: list[np.ndarray] = []
    top = base

    def name(rule: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which places get their rule, and the new symbols of those."""
        nonlocal top
        # The pair of the greatest weight loses no place, so each round makes a rule.
        made = np.bincount(rule, minlength=len(keys)) >= min_pairs
        order = np.flatnonzero(made)[np.argsort(keys[made])]
        names = np.empty(len(keys), np.int64)
        names[order] = np.arange(top, top + len(order))
        rules.append(np.stack((keys[order] >> 32, keys[order] & 0xFFFFFFFF), axis=1))
        top += len(order)
        won = made[rule]
        return won, names[rule[won]]

    open_places = ~last
    places = np.flatnonzero(open_places)
    while 3 * len(places) > len(symbols):
        low = len(symbols).bit_length()
        hits, found, keys, rare = _frequent(
            symbols.take(places), symbols[1:].take(places), places, places + 1,
            (top - 1).bit_length(), low, min_pairs,
        )
        if not len(keys):
            places = hits
            break
        open_places[rare] = False
        # The rank of each place, 0 where there is none.
        ranks = np.zeros(len(symbols) + 2, np.int32)
        ranks[1:][hits] = found
        here = ranks[1:-1]
        at = np.flatnonzero((here > ranks[:-2]) & (ranks[2:] <= here))
        won, names = name(here[at] - 1, keys)
        at = at[won]
        symbols[at] = names
        last[at] = last[at + 1]
        # The pairs before and after a new symbol are new.
        open_places[at] = True
        before = at[at > 0] - 1
        open_places[before] = True
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        # The symbol before a new one may itself have been merged away.
        merged = before[~keep[before]]
        open_places[merged - 1] = True
        kept = np.flatnonzero(keep)
        symbols, last, open_places = symbols.take(kept), last.take(kept), open_places.take(kept)
        open_places &= ~last
        places = np.flatnonzero(open_places)
    if len(places):
        # One place more, which is before the first and after the last symbol of a document.
        none = len(symbols)
        after = np.append(np.where(last, none, np.arange(1, none + 1)), none)
        before = np.append(np.arange(-1, none - 1), none)
        before[np.concatenate(([0], np.flatnonzero(last[:-1]) + 1))] = none
        ranks = np.zeros(none + 1, np.int32)
        keep = np.ones(none, bool)
        open_places = np.append(open_places, False)
        while len(places):
            follow = after[places]
            hits, found, keys, rare = _frequent(
                symbols[places], symbols[follow], places, follow,
                (top - 1).bit_length(), none.bit_length(), min_pairs,
            )
            if not len(keys):
                break
            open_places[rare] = False
            ranks[hits] = found
            wins = (ranks[before[hits]] < found) & (ranks[after[hits]] <= found)
            ranks[hits] = 0
            at = hits[wins]
            won, names = name(found[wins] - 1, keys)
            at = at[won]
            gone = after[at]
            symbols[at] = names
            last[at] = last[gone]
            keep[gone] = False
            after[at] = after[gone]
            before[after[gone]] = at
            before[none] = none
            open_places[gone] = False
            beside = np.concatenate((at, before[at]))
            open_places[beside] = after[beside] != none
            places = np.flatnonzero(open_places)
        symbols, last = symbols[keep], last[keep]
    made_rules = np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)
    ends = np.flatnonzero(last) + 1
    # Documents without ids end where the one before does.
    filled = np.diff(np.concatenate(([0], stops))) > 0
    new_stops = np.concatenate(([0], ends))[np.cumsum(filled)]
    return made_rules, symbols, new_stops


def _write_symbols(values: np.ndarray, width: int) -> bytes:
    if width <= 4:
        return values.astype(f"<u{width}").tobytes()
    planes = (np.packbits((values >> bit & 1).astype(bool)).tobytes() for bit in range(16, width))
    return b"".join((values.astype("<u2").tobytes(), *planes))


def _read_symbols(data: bytes, width: int, number: int) -> np.ndarray:
    if width <= 4:
        return np.frombuffer(data, f"<u{width}", number)
    values = np.frombuffer(data, "<u2", number).astype(np.uint32)
    size = -(-number // 8)
    for bit in range(16, width):
        plane = np.frombuffer(data, np.uint8, size, 2 * number + (bit - 16) * size)
        values |= np.unpackbits(plane, count=number).astype(np.uint32) << np.uint32(bit)
    return values


class Shard:
    """Random access to the ids of one shard row."""

    def __init__(self, row: dict):
        base, width = row["base"], row["width"]
        number = row["n_rules"] if width > 4 else len(row["rules"]) // (2 * width)
        kind = np.int32 if base + number < 1 << 31 else np.int64
        rules = _read_symbols(row["rules"], width, 2 * number).reshape(-1, 2).astype(kind)
        self.stops = np.frombuffer(row["stops"], "<u4").astype(np.int64)
        self.symbols = _read_symbols(row["symbols"], width, int(self.stops[-1]))
        self._base, self._left, self._right = base, *np.ascontiguousarray(rules.T)
        # A rule only uses symbols before it: all rules up to the first that uses one of
        # them get their lengths in one step.
        self.lengths = np.ones(base + len(rules), np.int64)
        reach = np.maximum.accumulate(rules.max(axis=1)) if len(rules) else np.zeros(0, np.int64)
        begin = 0
        while begin < len(rules):
            end = int(np.searchsorted(reach, base + begin))
            self.lengths[base + begin:base + end] = self.lengths[rules[begin:end]].sum(axis=1)
            begin = end

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        """Ids of a row of symbols: rules are opened level by level, each at its own place,
        so the work follows the ids asked for."""
        sizes = self.lengths.take(symbols)
        total = int(sizes.sum())
        kind = np.int32 if total < 1 << 31 else np.int64
        symbols = symbols.astype(self._left.dtype)
        places = (np.cumsum(sizes) - sizes).astype(kind)
        ids = np.zeros(total, np.uint32)
        while len(symbols):
            plain = symbols < self._base
            here, deeper = np.flatnonzero(plain), np.flatnonzero(~plain)
            ids[places.take(here)] = symbols.take(here)
            rule, places = symbols.take(deeper) - self._base, places.take(deeper)
            left, right = self._left.take(rule), self._right.take(rule)
            places = np.concatenate((places, places + self.lengths.take(left).astype(kind)))
            symbols = np.concatenate((left, right))
        return ids

    def document(self, place: int) -> np.ndarray:
        """Ids of one document; the others are not expanded."""
        begin = self.stops[place - 1] if place else 0
        return self._expand(self.symbols[begin:self.stops[place]])

    def ids(self) -> np.ndarray:
        """Ids of all documents, one after the other."""
        return self._expand(self.symbols)


_SHARD = (
    "part int, shard int, base int, width int, doc_ids array<long>, sizes binary, "
    "n_ids long, n_rules int, rules binary, symbols binary, stops binary"
)


def _pack(part: int, shard: int, base: int, names: list, ids: list[np.ndarray]) -> dict:
    sizes = np.array([len(one) for one in ids], np.int64)
    rules, symbols, stops = re_pair(np.concatenate(ids), np.cumsum(sizes), base)
    width = 2 if base + len(rules) <= 1 << 16 else (base + len(rules) - 1).bit_length()
    return {
        "part": part, "shard": shard, "base": base, "width": width, "doc_ids": names,
        "sizes": sizes.astype("<u4").tobytes(), "n_ids": int(sizes.sum()),
        "n_rules": len(rules), "rules": _write_symbols(rules.ravel(), width),
        "symbols": _write_symbols(symbols, width), "stops": stops.astype("<u4").tobytes(),
    }


def _text_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """Ids and texts in order, in groups of at most one text above ``GROUP_CHARS``."""
    for batch in batches:
        names, texts, held = [], [], 0
        for name, text in zip(batch.column("doc_id"), batch.column("text")):
            names.append(name.as_py())
            texts.append(text.as_py())
            held += len(texts[-1] or "")
            if held >= GROUP_CHARS:
                yield names, texts
                names, texts, held = [], [], 0
        if names:
            yield names, texts


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID,
    shard_ids: int = SHARD_IDS,
) -> None:
    """Encode whole texts, end each with ``end_id`` and write them in ascending doc_id order.

    Ids are dealt by ranges of (doc_id, hash of the text), so rows that share an id
    spread too; within a task they are sorted and shards are closed by size. Null ids
    come first, null and empty texts have the end id only, and rows that share an id
    follow in the order of their text's hash. No row gives no shard. Spark's writer
    commits the files, so a lost executor's shards are written again.
    """
    workers_import(docs.sparkSession)
    tokenizer = tokenizer or default_tokenizer()
    schema = pa.schema([
        ("part", pa.int32()), ("shard", pa.int32()), ("base", pa.int32()), ("width", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.binary()), ("n_ids", pa.int64()),
        ("n_rules", pa.int32()), ("rules", pa.binary()), ("symbols", pa.binary()), ("stops", pa.binary()),
    ])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = piece_encoder(tokenizer)
        base = max(encode.size, end_id + 1)
        part, shard = TaskContext.get().partitionId(), 0
        names, ids, held = [], [], 0
        end = np.array([end_id], np.uint32)
        for group_names, texts in _text_groups(batches):
            for name, found in zip(group_names, encode.encode_all(texts)):
                names.append(name)
                ids.append(np.concatenate((found, end)))
                held += len(ids[-1])
                if held >= shard_ids:
                    yield pa.RecordBatch.from_pylist([_pack(part, shard, base, names, ids)], schema)
                    names, ids, held, shard = [], [], 0, shard + 1
        if names:
            yield pa.RecordBatch.from_pylist([_pack(part, shard, base, names, ids)], schema)

    (
        docs.select("doc_id", "text", F.xxhash64("text").alias("version"))
        .repartitionByRange("doc_id", "version").sortWithinPartitions("doc_id", "version")
        .select("doc_id", "text").mapInArrow(pack, _SHARD).write.parquet(path)
    )


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` and, if asked, ``ids`` of each document.

    ``start`` counts the ids of all documents before: a running sum inside each write
    task, and one over the tasks' totals (a row per write task).
    """
    workers_import(spark)
    shards = spark.read.parquet(path)
    in_part = Window.partitionBy("part").orderBy("shard")
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("ids")).select(
        "part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("part_start")
    )
    starts = shards.select(
        "part", "shard", (F.sum("n_ids").over(in_part) - F.col("n_ids")).alias("in_part")
    ).join(totals, "part").select(
        "part", "shard", (F.col("in_part") + F.col("part_start")).alias("shard_start")
    )
    names = ["doc_id", "part", "shard", "in_shard", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    kinds = "doc_id long, part int, shard int, in_shard long, n_tokens long, ids_crc32 long"
    found = shards.drop("n_ids").mapInArrow(
        _unpacker(names), kinds + ", ids array<long>" * with_ids
    )
    return found.join(starts, ["part", "shard"]).select(
        "doc_id", (F.col("shard_start") + F.col("in_shard")).alias("start"), *names[4:]
    )


def _unpacker(names: list[str]) -> Callable:
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
                shard = Shard(row)
                sizes = np.frombuffer(row["sizes"], "<u4").astype(np.int64)
                ids = np.split(shard.ids(), np.cumsum(sizes)[:-1]) if len(sizes) else []
                total = len(sizes)
                columns = {
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "part": pa.array(np.full(total, row["part"], np.int32)),
                    "shard": pa.array(np.full(total, row["shard"], np.int32)),
                    "in_shard": pa.array(np.cumsum(sizes) - sizes),
                    "n_tokens": pa.array([len(one) for one in ids], pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(one.astype("<u4", copy=False)) for one in ids], pa.int64()),
                }
                if "ids" in names:
                    columns["ids"] = pa.array([one.astype(np.int64) for one in ids], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([columns[name] for name in names], names)

    return unpack


def round_trip(docs: DataFrame) -> DataFrame:
    """Write the documents' ids to the shared folder and report what the files hold."""
    spark = docs.sparkSession
    path = shared_path(spark, "tokens")
    write_tokens(docs.select("doc_id", "text"), path)
    return read_tokens(spark, path, with_ids=False)
