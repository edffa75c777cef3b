"""Byte-level BPE ids of many texts with the ``tokenizers`` library, pre-token by pre-token.

The library's own ``encode`` spends most of its time on objects per token. BPE never
crosses a pre-token, so here pre-tokens are found for a whole batch with numpy, each
distinct one is encoded once per worker by the library's model, and the ids are
gathered. The pre-token rule is that of byte-level BPE:

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

It is applied to texts whose characters lie below U+0240. Texts with others, or with
an added token of the vocabulary in them, go to the library's ``encode`` whole; so do all texts where the
vocabulary's file names another rule, or changes texts before. So
every text gets exactly what ``encode(text, add_special_tokens=False)`` returns. A file that
the library can't read is an error.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import words

_LETTER, _NUMBER, _OTHER, _SPACE = 1, 2, 3, 4
_SLOT_BITS = 21
_LONG = 128  # bytes of a pre-token
_LAST_LEAD = 0xC8  # lead byte of U+0200..U+023F


def _char_class(c: int) -> int:
    kind = unicodedata.category(chr(c))[0]
    if c in (*range(0x09, 0x0E), 0x20, 0x85, 0xA0):
        return _SPACE
    return {"L": _LETTER, "N": _NUMBER}.get(kind, _OTHER)


_CLASS = np.array([_char_class(c) for c in range(0x240)], np.uint8)


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def pretoken_starts(data: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Byte positions where pre-tokens begin, in UTF-8 of characters below U+0240. ``text_starts`` are those of non-empty texts."""
    n = len(data)
    kind = _CLASS[np.minimum(data, 0x7F)]
    lead = np.flatnonzero(data >= 0xC2)
    cont = (data >= 0x80) & (data < 0xC0)
    code = ((data[lead].astype(np.int32) & 0x1F) << 6) | (data[lead + 1] & 0x3F)
    kind[lead] = kind[lead + 1] = _CLASS[code]
    new_text = np.zeros(n + 1, bool)
    new_text[text_starts] = True
    new_text[n] = True
    space = kind == _SPACE
    start = np.ones(n, bool)
    start[1:] = kind[1:] != kind[:-1]
    start[1:] &= ~((data[:-1] == 0x20) & ~space[1:])  # a plain space goes with what follows it
    # the last of several white-space characters before a visible one stands apart
    size = np.ones(n, np.int8)
    size[lead] = 2
    at = np.flatnonzero(space & ~cont)
    following = at + size[at]
    visible = ~new_text[following]
    visible[visible] = ~space[following[visible]]
    start[at[visible]] = True
    start[cont] = False
    start |= new_text[:n]
    quotes = np.flatnonzero((data == 0x27) & start)
    if len(quotes):
        padded = np.concatenate((data, np.zeros(3, np.uint8)))
        ended = np.concatenate((new_text, np.ones(3, bool)))
        a, b = padded[quotes + 1], padded[quotes + 2]
        one = ~ended[quotes + 1] & np.isin(a, np.frombuffer(b"stmd", np.uint8))
        pair = ((a == 0x72) & (b == 0x65)) | ((a == 0x76) & (b == 0x65)) | ((a == 0x6C) & (b == 0x6C))
        two = ~one & pair & ~ended[quotes + 1] & ~ended[quotes + 2]
        for found, length in ((quotes[one], 2), (quotes[two], 3)):
            start[found + 1] = False
            after = found + length
            start[after[after < n]] = True
    return np.flatnonzero(start)


class Encoder:
    """Encodes batches of texts; keeps the ids of pre-tokens in a direct-mapped cache, at most ``keep`` at a time."""

    def __init__(self, path: str, keep: int = 1_000_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        named = json.loads(self.tokenizer.to_str())
        rule, model = named["pre_tokenizer"] or {}, named["model"]
        self.own_rule = rule.get("type") == "ByteLevel" and not rule["add_prefix_space"] and rule.get("use_regex", True)
        self.own_rule &= named["normalizer"] is None and model["type"] == "BPE" and not any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges"))
        self.alphabet = {b: c for b, c in enumerate(byte_alphabet())}
        self.keep = keep
        self.vocabulary = self.tokenizer.get_vocab_size()
        self._clear()

    def _clear(self) -> None:
        self.count = 0
        self.flat = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.offset = np.zeros(1 << 16, np.int64)
        self.length = np.zeros(1 << 16, np.int32)
        self.slot_key = np.zeros(1 << _SLOT_BITS, np.uint64)
        self.slot_at = np.zeros(1 << _SLOT_BITS, np.int32)

    def _learn(self, raw: bytes, starts: list[int], ends: list[int]) -> int:
        """Keeps the ids of some pre-tokens, one after the other; where the first of them is kept."""
        tokenize, alphabet = self.model.tokenize, self.alphabet
        ids: list[int] = []
        lengths = []
        for a, b in zip(starts, ends, strict=True):
            found = [x.id for x in tokenize(raw[a:b].decode("latin-1").translate(alphabet))]
            ids += found
            lengths.append(len(found))
        first, n = self.count, len(lengths)
        if first + n > len(self.offset):
            more = np.zeros(max(len(self.offset), n), np.int64)
            self.offset, self.length = np.concatenate((self.offset, more)), np.concatenate((self.length, more.astype(np.int32)))
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros(max(len(self.flat), len(ids)), np.uint32)))
        self.flat[self.used : self.used + len(ids)] = ids
        self.length[first : first + n] = lengths
        self.offset[first : first + n] = self.used + np.cumsum(lengths) - lengths
        self.count += n
        self.used += len(ids)
        return first

    def _indices(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where the ids of each pre-token are kept."""
        if self.count > self.keep:
            self._clear()
        slot = hashes >> np.uint64(64 - _SLOT_BITS)
        at = self.slot_at[slot]
        missing = np.flatnonzero(self.slot_key[slot] != hashes)
        if len(missing):
            distinct, first, which = np.unique(hashes[missing], return_index=True, return_inverse=True)
            where = missing[first]
            found = self._learn(data.tobytes(), starts[where].tolist(), ends[where].tolist()) + np.arange(len(where), dtype=np.int32)
            at[missing] = found[which]
            slots = distinct >> np.uint64(64 - _SLOT_BITS)
            self.slot_key[slots], self.slot_at[slots] = distinct, found
        return at

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text (null: none)."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = np.full(len(texts), not self.own_rule)
        for added in self.added:
            whole |= pc.match_substring(texts, added).to_numpy(zero_copy_only=False)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        high = np.flatnonzero(raw[offsets[0] : offsets[-1]] > _LAST_LEAD) + offsets[0]
        whole[np.searchsorted(offsets, high, side="right") - 1] = True
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        for i in np.flatnonzero(whole).tolist():
            out[i] = np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, np.uint32)
        rest = np.flatnonzero(~whole & (np.diff(offsets) > 0))
        if not len(rest):
            return out
        if len(rest) < len(texts):
            data = np.concatenate([raw[offsets[i] : offsets[i + 1]] for i in rest.tolist()])
        else:
            data = raw[offsets[0] : offsets[-1]]
        bounds = np.concatenate(([0], np.cumsum(np.diff(offsets)[rest])))
        starts = pretoken_starts(data, bounds[:-1])
        ends = np.append(starts[1:], len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(words._VALUE[data] * words.powers(words._BASE, len(data)), out=sums[1:])
        hashes = words.mix((sums[ends] - sums[starts]) * words.powers(words._INVERSE, len(data))[starts])
        for i in np.flatnonzero(ends - starts > _LONG).tolist():  # a polynomial alone could be made to agree on long runs
            hashes[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
        at = self._indices(hashes, data, starts, ends)
        length = self.length[at].astype(np.int64)
        begin = self.offset[at]
        total = np.concatenate(([0], np.cumsum(length)))
        ids = self.flat[np.repeat(begin - total[:-1], length) + np.arange(total[-1])]
        cuts = total[np.searchsorted(starts, bounds)]
        for k, i in enumerate(rest.tolist()):
            out[i] = ids[cuts[k] : cuts[k + 1]]
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
