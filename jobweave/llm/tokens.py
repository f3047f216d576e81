"""Encoding with a public byte-level BPE tokenizer, inside tasks.

The library encodes whole texts at about a megabyte a second.  Most of that goes into words
it has met before, so texts are cut where the tokenizer itself cuts, before any merging, and
each distinct piece goes through the library once per worker.  A text that holds a character
for which that cut isn't known to be the tokenizer's own goes through the library whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces kept by a worker; beyond it the store starts anew.
CACHE_PIECES = 800_000
#: Bytes of text looked at together.
PART_BYTES = 4 << 20

# Classes of bytes for the quick look at a text.
_OTHER, _WORD, _SPACE, _STOP, _MARK, _LEAD = 0, 1, 2, 3, 4, 5
_KIND = np.full(256, _OTHER, dtype=np.uint8)
_KIND[0x21:0x7F] = _MARK
for _c in b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _KIND[_c] = _WORD
_KIND[ord(" ")] = _KIND[ord("\n")] = _SPACE
_KIND[ord(".")] = _KIND[ord(",")] = _STOP
_KIND[0xC3] = _LEAD  # first byte of the letters from U+00C0 to U+00FF

_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
# The tokenizer's rule for cutting, a fixed value, over ASCII, line breaks and these letters.
_CUT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^ \n{_LETTER}0-9]+|[ \n]+(?![^ \n])|[ \n]+")

_PLAIN, _SIMPLE, _WHOLE = 0, 1, 2


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes one after the other, and where each begins, and the end."""
    blob = texts.cast(pa.binary())
    offsets = np.frombuffer(blob.buffers()[1], np.int32)[blob.offset : blob.offset + len(blob) + 1].astype(np.int64)
    return np.frombuffer(blob.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _ways(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How each text may be cut: at single blanks, stops and breaks; by the rule; not at all."""
    kind = _KIND[data]
    lead = np.flatnonzero(kind == _LEAD)
    if len(lead):
        after = data[np.minimum(lead + 1, len(data) - 1)]
        kind[np.minimum(lead + 1, len(data) - 1)] = np.where((after == 0x97) | (after == 0xB7), _OTHER, _WORD)
        kind[lead] = _WORD
    before = np.empty_like(kind)
    before[1:] = kind[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = _WORD
    odd = (before == _SPACE) & (kind == _SPACE) | (kind == _STOP) & (before != _WORD)

    def some(flags: np.ndarray) -> np.ndarray:
        at = np.searchsorted(np.flatnonzero(flags), offsets)
        return at[1:] > at[:-1]

    return np.where(some(kind == _OTHER), _WHOLE, np.where(some(odd), _SIMPLE, _PLAIN))


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit integers.

    ``plain_specials``: strings of special tokens in a text are ordinary text; otherwise, as by
    the library's default, they become the special id.
    """

    def __init__(self, path: str, plain_specials: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        self.specials = () if plain_specials else tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        if hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)  # each piece comes once
        self.known: dict[str, bytes] = {}
        (self.line_break,) = self.tokenizer.encode("\n", add_special_tokens=False).ids

    def _ask(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in done]

    def _learn(self, pieces: list[str]) -> None:
        """Have the library encode new pieces, many in one text: a line break between two pieces
        is always a token of its own, so its id parts them again."""
        inner = [p for p in pieces if p and not p[-1].isspace()]
        for at in range(0, len(inner), 20_000):
            some = inner[at : at + 20_000]
            ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = np.append(np.flatnonzero(ids == self.line_break), len(ids))
            raw = ids.tobytes()
            if len(ends) != len(some):
                raise ValueError("a piece holds a line break")
            starts = [0, *(4 * (ends[:-1] + 1)).tolist()]
            self.known.update(zip(some, [raw[a:b] for a, b in zip(starts, (4 * ends).tolist())]))
        rest = [p for p in pieces if not p or p[-1].isspace()]
        self.known.update(zip(rest, self._ask(rest)))

    def _look_up(self, pieces: list[str]) -> list[bytes]:
        if len(self.known) > CACHE_PIECES:
            self.known.clear()
        found = list(map(self.known.get, pieces))
        gaps = [i for i, v in enumerate(found) if v is None]
        if gaps:
            self._learn(list({pieces[i] for i in gaps}))
            for i in gaps:
                found[i] = self.known[pieces[i]]
        return found

    def _plain(self, texts: pa.Array) -> list[bytes]:
        """Ids of texts that may be cut at single blanks, stops and breaks."""
        data, offsets = _bytes_of(texts)
        kind = _KIND[data]
        cut = (kind == _SPACE) | (kind == _STOP)
        cut[1:] |= data[:-1] == 0x0A
        cut[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(cut).astype(np.int32)
        ends = np.append(starts, len(data)).astype(np.int32)
        pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(data))
        coded = pieces.dictionary_encode()
        codes = coded.indices.to_numpy()
        values = self._look_up(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        flat = np.frombuffer(b"".join(values), dtype="<u4")
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
        at = np.cumsum(sizes) - sizes
        n = sizes[codes]
        upto = np.cumsum(n)
        place = np.repeat(at[codes] - (upto - n), n)
        place += np.arange(len(place))
        raw = flat[place].tobytes()
        bounds = (4 * np.concatenate([[0], upto])[np.searchsorted(starts, offsets)]).tolist()
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]

    def _part(self, texts: pa.Array) -> list[bytes]:
        data, offsets = _bytes_of(texts)
        if not len(data):
            return [b""] * len(texts)
        ways = _ways(data, offsets)
        for special in self.specials:
            holds = pc.match_substring(texts, special).to_numpy(zero_copy_only=False).astype(bool)
            ways[holds] = _WHOLE
        plain = ways == _PLAIN
        if plain.all():
            return self._plain(texts)
        out: list[bytes] = [b""] * len(texts)
        if plain.any():
            for i, ids in zip(np.flatnonzero(plain).tolist(), self._plain(texts.filter(pa.array(plain)))):
                out[i] = ids
        for i in np.flatnonzero(ways == _SIMPLE).tolist():
            out[i] = b"".join(self._look_up(_CUT.findall(texts[i].as_py())))
        whole = np.flatnonzero(ways == _WHOLE).tolist()
        for i, ids in zip(whole, self._ask([texts[i].as_py() for i in whole])):
            out[i] = ids
        return out

    def encode(self, texts: list[str] | pa.Array) -> Iterator[bytes]:
        """The ids of each text, in order; some megabytes of text are held at a time."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        column = column.cast(pa.string()) if not pa.types.is_string(column.type) else column
        if column.null_count:
            column = column.fill_null("")
        ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(column):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PART_BYTES, "right")))
            yield from self._part(column.slice(at, to - at))
            at = to
