"""Token ids of many single words at once, by the public libraries; used inside tasks.

Both encoders take distinct words as bytes, one after another, and give the ids of all words and how
many each word has. The byte-level one hands the library's own model many words in one string,
cut at a character that its alphabet doesn't have, which is cheaper than a call a word."""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np

from repolens.llm.common import take_slices

#: Words handed to a library in one call, and in one string; words of each of two generations that a worker remembers.
WORDS_A_CALL, WORDS_A_STRING, KNOWN_WORDS = 16384, 64, 200_000


@lru_cache(maxsize=1)
def byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: printable bytes stand
    for themselves, the others for the characters from 256 on, in their order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _table(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(tokens), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)


class ByteLevel:
    """Words by a byte-level BPE tokenizer of the tokenizers library, given as its JSON text."""

    def __init__(self, content: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._bytes = {c: b for b, c in byte_alphabet().items()}
        self._letters = {b: c for b, c in byte_alphabet().items()}
        found = json.loads(content)
        if found["normalizer"] or found["pre_tokenizer"] != found["pre_tokenizer"] | {"type": "ByteLevel", "add_prefix_space": False}:
            raise ValueError("not a byte-level tokenizer that leaves texts as they are")
        vocab = found["model"]["vocab"]
        tokens = [b""] * (max([*vocab.values(), *(t["id"] for t in found["added_tokens"])]) + 1)
        for token, i in vocab.items():
            if all(c in self._bytes for c in token):
                tokens[i] = bytes(self._bytes[c] for c in token)
        #: Bytes of all tokens in the order of the ids, and bounds.
        self.data, self.bounds = _table(tokens)
        self.size = np.diff(self.bounds)
        self._one = Tokenizer(Tokenizer.from_str(content).model)
        self._one.pre_tokenizer = pre_tokenizers.Split("\n", "removed")

    def encode(self, body: bytes, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each word); no word is empty."""
        ids = [np.zeros(0, np.int64)]
        for i in range(0, len(bounds) - 1, WORDS_A_CALL):
            part = bounds[i : i + WORDS_A_CALL + 1].tolist()
            mapped = body[part[0] : part[-1]].decode("latin-1").translate(self._letters)
            words = [mapped[x - part[0] : y - part[0]] for x, y in zip(part, part[1:])]
            strings = ["\n".join(words[k : k + WORDS_A_STRING]) for k in range(0, len(words), WORDS_A_STRING)]
            ids += [np.array(e.ids, np.int64) for e in self._one.encode_batch_fast(strings, add_special_tokens=False)]
        flat = np.concatenate(ids)
        ends = np.cumsum(self.size[flat])
        return flat, np.diff(np.searchsorted(ends, bounds - bounds[0], "right"))


class Pieces:
    """Words by a BPE model of the sentencepiece library. A word is a run of spaces and what follows up to the next
    space; its first space is the one that the library puts before what it is given. No piece of such a model has
    a space behind another character, so nothing merges across words; the constructor checks that."""

    def __init__(self, model: bytes):
        import sentencepiece

        self._sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self._sp.id_to_piece(i) for i in range(self._sp.get_piece_size())]
        if any("▁" in n.lstrip("▁") for n in names):
            raise ValueError("a piece goes on behind a space")
        tokens = [bytes([int(n[3:5], 16)]) if self._sp.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        self.data, self.bounds = _table(tokens)
        self.size = np.diff(self.bounds)
        self._space = names.index("▁")

    def encode(self, body: bytes, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each word)."""
        ids, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in range(0, len(bounds) - 1, WORDS_A_CALL):
            part = bounds[i : i + WORDS_A_CALL + 1].tolist()
            found = self._sp.encode([body[x + 1 : y].decode() for x, y in zip(part, part[1:])], num_threads=1)
            found = [f or [self._space] for f in found]
            counts.append(np.array([len(f) for f in found], np.int64))
            ids.append(np.array([x for f in found for x in f], np.int64))
        return np.concatenate(ids), np.concatenate(counts)

    def words(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bounds of the words of texts that all begin with a space."""
        space = data == 32
        begin = space.copy()
        begin[1:] &= ~space[:-1]
        begin[offsets[:-1][offsets[:-1] < len(data)]] = True
        return np.append(np.flatnonzero(begin), len(data)).astype(np.int64)

    def exact(self, words, ids: np.ndarray, counts: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the bytes of each word's tokens, joined, are the word (``words``: their bytes and sizes)."""
        first = np.concatenate([[0], np.cumsum(counts)])
        ends = np.concatenate([[0], np.cumsum(self.size[ids])])
        made = np.diff(ends[first])
        fine = made == size
        if not fine.all():
            flat = np.repeat(fine, counts)
            ids, words = ids[flat], words[np.repeat(fine, size)]
            made = made[fine]
        same = take_slices(self.data, self.bounds[ids], self.size[ids]) == words
        out = np.zeros(len(fine), bool)
        wrong = np.concatenate([[0], np.cumsum(~same)])
        at = np.concatenate([[0], np.cumsum(made)])
        out[fine] = wrong[at[1:]] == wrong[at[:-1]]
        return out


class Remembered:
    """An encoder that remembers words: those met since the last change of generation, and the generation before."""

    def __init__(self, encoder, known: int = KNOWN_WORDS):
        self.encoder, self._known = encoder, known
        self._young: dict[bytes, bytes] = {}
        self._old: dict[bytes, bytes] = {}

    def encode(self, distinct, fixed: dict[bytes, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each) of an array of distinct binary words; ``fixed``: words with an id of their own."""
        words, young, old = distinct.to_pylist(), self._young, self._old
        got = [young.get(w) or old.get(w) for w in words]
        new = [i for i, x in enumerate(got) if x is None]
        if new:
            fresh = [words[i] for i in new]
            bounds = np.concatenate([[0], np.cumsum([len(w) for w in fresh])]).astype(np.int64)
            ids, counts = self.encoder.encode(b"".join(fresh), bounds)
            raw, ends = ids.astype("<i4").tobytes(), (4 * np.cumsum(counts)).tolist()
            for i, a, b in zip(new, [0, *ends], ends):
                got[i] = raw[a:b]
        young.update((w, x) for w, x in zip(words, got) if len(w) < 64)
        if len(young) > self._known:
            self._young, self._old = {}, young
        if fixed:
            got = [x if (i := fixed.get(w)) is None else i.to_bytes(4, "little") for w, x in zip(words, got)]
        return np.frombuffer(b"".join(got), "<i4").astype(np.int64), np.fromiter(map(len, got), np.int64, len(got)) // 4
