"""Token ids of whole batches of texts with a byte-level BPE tokenizer of the tokenizers library."""

from __future__ import annotations

import json
import os

import numpy as np
import pyspark

from slotwise.llm.text import span_hashes

END_ID = 0
CACHE = 1_000_000  # distinct pieces a worker remembers; then it starts anew
JOINED = 20  # pieces given to the library as one text


def _table(bytes_) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(bytes_)] = True
    return out


_VISIBLE = _table(range(0x21, 0x7F))
_LETTER = _table([*range(0x41, 0x5B), *range(0x61, 0x7B)])
_POINT = _table(x for x in range(0x21, 0x7F) if not chr(x).isalnum())


class PieceEncoder:
    """Encodes texts piece by piece, each distinct piece once.

    The tokenizer splits a text by a pattern before it merges bytes, and no part of the split
    reaches from a visible character over a following space, or from a letter over a following
    punctuation mark. So a text may be cut there, and its ids are those of its pieces in turn.
    Texts that hold one of the tokenizer's special tokens are encoded whole.

    A special token ends a part of the text before anything else happens, so new pieces go to the library
    ``JOINED`` at a time with one between them: a text of its own for each costs more than its merges.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = spec.get("added_tokens") or []
        self.special = [t["content"].encode() for t in added]
        plain = [t for t in added if t.get("special") and not any(t.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized"))]
        self.between = (plain[0]["content"], plain[0]["id"]) if plain else None
        split = spec.get("pre_tokenizer") or {}
        self.cuts = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and not spec.get("normalizer")
        self._clear()

    def _clear(self):
        self.keys = np.empty(0, np.uint64)
        self.begin, self.count = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        out = []  # a part at a time, as the library's encodings take far more room than their ids
        for at in range(0, len(texts), 1_000):
            out += [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts[at : at + 1_000], add_special_tokens=False)]
        return out

    def _distinct(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after the other, and how many each has. No piece holds a special token."""
        if self.between is None:
            ids = self._whole(pieces)
            return np.concatenate(ids), np.fromiter(map(len, ids), np.int64, len(ids))
        text, mark = self.between
        flat = np.concatenate(self._whole([text.join([*pieces[a : a + JOINED], ""]) for a in range(0, len(pieces), JOINED)]))
        ends = flat == mark
        return flat[~ends], np.diff(np.flatnonzero(ends), prepend=-1) - 1

    def _pieces(self, buffer: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = int(offsets[-1])
        now = buffer[:n]
        cut = np.zeros(n + 1, bool)
        if self.cuts and n > 1:
            before, after = now[:-1], buffer[2 : n + 1]
            space = now[1:] == 0x20
            cut[1:n] = space & (_VISIBLE[before] | ((before >= 0x80) & _VISIBLE[after]))
            cut[1:n] |= _LETTER[before] & _POINT[now[1:]]
            # a text's last byte has nothing after it
            ends = offsets[1:][offsets[1:] > 1] - 1
            cut[ends] &= _VISIBLE[now[ends - 1]]
        cut[offsets] = True
        cut[n] = False
        return np.flatnonzero(cut)

    def _look_up(self, keys: np.ndarray, texts) -> tuple[np.ndarray, np.ndarray]:
        """Begin and number of the ids of distinct pieces; ``texts(i)`` gives the strings of new ones."""
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        new = np.flatnonzero(self.keys[at] != keys) if len(self.keys) else np.arange(len(keys))
        if len(new):
            if len(self.keys) + len(new) > CACHE and len(self.keys):
                self._clear()
                return self._look_up(keys, texts)
            flat, count = self._distinct(texts(new))
            begin = len(self.ids) + np.cumsum(count) - count
            self.ids = np.concatenate([self.ids, flat])
            merged = np.concatenate([self.keys, keys[new]])
            order = np.argsort(merged, kind="stable")
            self.keys = merged[order]
            self.begin = np.concatenate([self.begin, begin])[order]
            self.count = np.concatenate([self.count, count])[order]
            at = np.searchsorted(self.keys, keys)
        return self.begin[at], self.count[at]

    def encode(self, buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of ids of each text."""
        n = int(offsets[-1])
        raw = buffer[:n].tobytes()
        if any(s in raw for s in self.special):
            return self._encode_some_whole(raw, offsets)
        begin = self._pieces(buffer, offsets)
        if not len(begin):
            return np.empty(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        end = np.append(begin[1:], n)
        keys, first, piece = np.unique(span_hashes(buffer, begin, end), return_index=True, return_inverse=True)
        b, e = begin[first], end[first]
        at, count = self._look_up(keys, lambda new: [raw[x:y].decode() for x, y in zip(b[new].tolist(), e[new].tolist())])
        size = count[piece]
        last = np.cumsum(size)
        where = np.repeat(at[piece] - (last - size), size) + np.arange(int(last[-1]))
        before = np.concatenate([[0], last])[np.searchsorted(begin, offsets)]
        return self.ids[where], np.diff(before)

    def _encode_some_whole(self, raw: bytes, offsets: np.ndarray):
        texts = [raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        ids = self._whole(texts)
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.concatenate(ids), count


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for this file; workers live on between tasks, and what they know with them."""
    # one thread: Spark runs a worker per core, and each further thread keeps memory of its own
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    held = pyspark.__dict__.setdefault("_piece_encoders", {})
    if path not in held:
        held[path] = PieceEncoder(path)
    return held[path]


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
