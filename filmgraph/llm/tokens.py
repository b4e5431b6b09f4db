"""Token ids of whole texts by the ``tokenizers`` library.

A byte-level tokenizer of this kind first splits a text by a pattern, and always splits between a
non-space character and the white space behind it, around a line feed, and between a letter and a
full stop or comma. Texts with longer runs of white space or with a special token go to the library
whole; a batch of the others is cut at those places, and each different piece is looked up, by a
64-bit hash and its length, in a bounded table of arrays that the library's model fills (two
different pieces pass for one with a chance of about 1e-13 for each look-up in a full table). Tests
hold the ids against the library's for whole texts.
"""

from __future__ import annotations

import re

import numpy as np

from .hashing import hash_ranges

TABLE_PIECES = 500_000
BATCH_BYTES = 1 << 19             # texts hashed at once; longer ones are cut piece by piece
# runs of white space whose inner cuts could change ids
_UNSAFE = re.compile(r"\s\s(?:\s|$)")
_CUT = re.compile(r"(?=[ \n])|(?<=\n)|(?<=[A-Za-z])(?=[.,])")
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord("."), ord(",")]] = True


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable latin-1
    characters stand for themselves, the others follow from U+0100 on."""
    own = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace() and b != 0xAD]
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        # a special token ends the text before it, so such texts go to the library whole
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        letters = byte_letters()
        self.letters, self.space = str.maketrans(dict(enumerate(letters))), letters[0x20]
        self.stops = {s: self.whole(s) for s in ".,"}
        self._reset()

    def _reset(self) -> None:
        # sorted hashes of the pieces seen; place of their ids in the store, how many, and bytes
        self.keys = np.zeros(0, dtype=np.uint64)
        self.rows = np.zeros((3, 0), dtype=np.int32)
        self.store = np.zeros(0, dtype="<u4")

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _word(self, word: str) -> list[int]:
        """Ids of letters with at most a space before them: one token before the merges."""
        if word.isascii():
            letters = word.replace(" ", self.space)
        else:
            letters = word.encode("utf-8").decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(letters)]

    def _piece(self, piece: str) -> list[int]:
        bare = piece[1:] if piece[:1] == " " else piece
        if bare.isalpha():
            return self._word(piece)
        if bare[-1:] in (".", ",") and bare[:-1].isalpha():
            return self._word(piece[:-1]) + self.stops[bare[-1]]
        return self.whole(piece)

    def _learn(self, keys: np.ndarray, pieces: list[bytes]) -> None:
        """Add pieces that the table does not hold; ``keys`` are their sorted hashes."""
        ids = [self._piece(p.decode("utf-8")) for p in pieces]
        count = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        first = len(self.store) + np.cumsum(count) - count
        size = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        self.store = np.concatenate([self.store, np.fromiter(
            (x for own in ids for x in own), dtype="<u4", count=int(count.sum()))])
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        new = np.stack([first, count, size]).astype(np.int32)
        self.rows = np.insert(self.rows, at, new, axis=1)

    def ids(self, text: str | None) -> np.ndarray:
        """Ids of a text as uint32 (null and empty: none)."""
        return self.batch([text])[0]

    def batch(self, texts) -> list[np.ndarray]:
        """Ids of each text."""
        out: list[np.ndarray] = [np.zeros(0, dtype="<u4")] * len(texts)
        waiting, size = [], 0
        for i, text in enumerate(texts):
            if not text:
                continue
            if _UNSAFE.search(text) or any(s in text for s in self.special):
                out[i] = np.asarray(self.whole(text), dtype="<u4")
                continue
            raw = text.encode("utf-8")
            if len(raw) > BATCH_BYTES:
                pieces = filter(None, _CUT.split(text))
                out[i] = np.fromiter((x for p in pieces for x in self._piece(p)), dtype="<u4")
                continue
            waiting.append((i, raw))
            size += len(raw)
            if size >= BATCH_BYTES:
                self._fill(out, waiting)
                waiting, size = [], 0
        if waiting:
            self._fill(out, waiting)
        return out

    def _fill(self, out: list[np.ndarray], texts: list[tuple[int, bytes]]) -> None:
        if len(self.keys) > TABLE_PIECES:
            self._reset()
        buffer = b"".join(raw for _, raw in texts)
        data = np.frombuffer(buffer, dtype=np.uint8)
        ends = np.cumsum([len(raw) for _, raw in texts])
        feed = data == 0x0A
        begins = (data == 0x20) | feed
        begins[1:] |= feed[:-1] | (_STOP[data[1:]] & _LETTER[data[:-1]])
        begins[0] = True
        begins[ends[:-1]] = True
        start = np.flatnonzero(begins)
        end = np.append(start[1:], len(data))
        keys, one, which = np.unique(hash_ranges(data, start, end), return_index=True,
                                     return_inverse=True)
        size = (end - start)[one]
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), dtype=bool)
        if len(self.keys):
            held = np.minimum(at, len(self.keys) - 1)
            known = (self.keys[held] == keys) & (self.rows[2, held] == size)
        new = np.flatnonzero(~known)
        if len(new):
            self._learn(keys[new], [buffer[a:b] for a, b in zip(
                start[one[new]].tolist(), end[one[new]].tolist(), strict=True)])
            at = np.searchsorted(self.keys, keys)
        first, count = (self.rows[i, at].astype(np.int64)[which] for i in (0, 1))
        behind = np.cumsum(count)
        flat = self.store[np.arange(behind[-1]) + np.repeat(first - behind + count, count)]
        upto = behind[np.searchsorted(start, ends) - 1]
        for (i, _), a, b in zip(texts, [0, *upto[:-1]], upto, strict=True):
            out[i] = flat[a:b]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and path."""
    if path not in _encoders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[path] = Encoder(path)
    return _encoders[path]
