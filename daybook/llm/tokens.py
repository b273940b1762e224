"""Token ids of whole texts by the tokenizers library, with a bounded memory of pieces.

Both vocabularies here cut a text at white space before anything else, so a text
is encoded as the sequence of its pieces between cuts, and a piece met before is
not encoded again. Texts are cut many in a call, on their bytes, and each distinct
piece is looked up once for all its places. New pieces are encoded many in a call:
runs of letters in a row, as their tokens show where each ends, and the rest joined
by a separator whose one id occurs nowhere else.

The strings of the vocabulary's added tokens (such as an end of text) become
their ids, as the library has it by default: a text that holds one is encoded
whole by the library itself. With ``specials=False``
these strings are ordinary text.
"""

from __future__ import annotations

import gc
import os
import re
from functools import lru_cache
from itertools import compress
from unicodedata import normalize

import numpy as np
import pyarrow as pa

from .common import SPACE

#: Unicode white space.
_WS = "\t-\r \x85\xa0  -     　"

#: The bytes of those beyond ASCII as numbers, all of two or three bytes, and their first bytes.
_WIDE = np.array([int.from_bytes(c.encode()) for c in re.findall(f"[{_WS}]", "".join(map(chr, range(0x80, 0x3001))))])
_LEAD = np.zeros(256, bool)
_LEAD[[c >> 8 if c < 1 << 16 else c >> 16 for c in _WIDE.tolist()]] = True


def spaces(buf: np.ndarray) -> np.ndarray:
    """True at the bytes of white space, in UTF-8."""
    out = SPACE[buf]
    lead = np.flatnonzero(_LEAD[buf])
    second, third = np.minimum(lead + 1, len(buf) - 1), np.minimum(lead + 2, len(buf) - 1)
    two = (buf[lead].astype(np.int64) << 8) + buf[second]
    three = np.isin((two << 8) + buf[third], _WIDE)
    two = np.isin(two, _WIDE) | three
    out[lead[two]] = out[second[two]] = True
    out[third[three]] = True
    return out


def piece_starts(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces of texts that keep white space start.

    A run of white space is a piece but for its last character, if a word
    follows: a space belongs to the word, another is a piece of its own.
    """
    space, start = spaces(buf), np.zeros(len(buf) + 1, bool)
    start[offsets] = True
    turn = np.flatnonzero(space[1:] != space[:-1]) + 1
    word = turn[~(space[turn] | start[turn])]  # words after white space of their own text
    tail, last = buf[word - 1], word - 1
    wide = np.flatnonzero(tail >= 0x80)
    last[wide] -= np.where(buf[last[wide] - 1] == 0xC2, 1, 2)
    start[turn[space[turn]]] = start[last] = start[word[tail != 0x20]] = True
    return np.flatnonzero(start[:-1])


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Punctuation that no pre-tokenizer here joins with letters.
_POINTS = ".,;:!?"


class PieceEncoder:
    """ids(texts): little-endian unsigned 32-bit ids of each text, as bytes.

    ``drops_space``: the vocabulary drops white space (pieces are the words);
    otherwise a piece is a run of other characters with the one space before it,
    or the white space left between those, as byte-level pre-tokenizers cut.
    About ``memory`` pieces are remembered: when the younger half is full, the
    older is forgotten, but for what was met again.
    """

    def __init__(self, path: str, drops_space: bool, memory: int = 800_000, specials: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if specials else []
        self.added = re.compile("|".join(map(re.escape, added)).encode()).search if added else lambda text: None
        self.tokenizer.encode_special_tokens = True  # pieces hold none
        self.drops_space, self.memory, self.known, self.older = drops_space, memory, {}, {}
        self.mark, self.glue = ("\x00", " \x00 ") if drops_space else ("\n", "\n")
        (self.mark_id,) = self._encode([self.mark])[0]
        # where a run of letters ends (its last token says so) or starts (its first token holds the space)
        vocabulary = self.tokenizer.get_vocab()
        self.edge = np.zeros(max(vocabulary.values()) + 1, bool)
        self.edge[[i for t, i in vocabulary.items() if (t.endswith("</w>") if drops_space else t.startswith("\u0120"))]] = True

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_apart(self, texts: list[str]) -> dict[str, bytes]:
        """Ids of any texts, joined by the separator where that is safe."""
        out = {}
        plain = [t for t in texts if self.mark not in t and (self.drops_space or not t[-1].isspace())]
        for lo in range(0, len(plain), 4096):
            some = plain[lo : lo + 4096]
            ids = np.array(self._encode([self.glue.join(some)])[0], "<u4")
            ends = np.flatnonzero(ids == self.mark_id)
            if len(ends) == len(some) - 1:
                bounds = [-1, *ends.tolist(), len(ids)]
                out.update((t, ids[a + 1 : b].tobytes()) for t, a, b in zip(some, bounds[:-1], bounds[1:]))
        rest = [t for t in texts if t not in out]
        out.update((t, np.array(ids, "<u4").tobytes()) for t, ids in zip(rest, self._encode(rest)))
        return out

    def _encode_letters(self, runs: list[str]) -> dict[str, bytes]:
        """Ids of runs of letters (with their space, if it is kept): one pre-token each, so their tokens show the cuts."""
        out = {}
        for lo in range(0, len(runs), 4096):
            some = runs[lo : lo + 4096]
            ids = np.array(self._encode([(" " if self.drops_space else "").join(some)])[0], "<u4")
            at = np.flatnonzero(self.edge[ids])
            if len(at) != len(some):  # a letter whose lower case is no letter
                out.update(self._encode_apart(some))
                continue
            bounds = [0, *(at + 1).tolist()] if self.drops_space else [*at.tolist(), len(ids)]
            raw = ids.tobytes()
            out.update(zip(some, [raw[4 * a : 4 * b] for a, b in zip(bounds[:-1], bounds[1:])]))
        return out

    def _unknown(self, texts: list[str]) -> list[str]:
        """Those of ``texts`` that nothing is known of; what the older half knows is taken over."""
        texts = [t for t in texts if t not in self.known]
        if self.older:
            self.known.update((t, self.older[t]) for t in texts if t in self.older)
            texts = [t for t in texts if t not in self.known]
        return texts

    def _learn(self, texts: list[str]) -> None:
        runs = [t.rstrip(_POINTS) for t in texts]
        if self.drops_space:  # letters that are still letters when the vocabulary has normalised them
            fine = [r.isalpha() and (r.isascii() or normalize("NFC", r).lower().isalpha()) for r in runs]
        else:
            fine = [r[:1] == " " and r[1:].isalpha() for r in runs]
        known, pointed = self.known, [(t, r, t[len(r) :]) for t, r in zip(compress(texts, fine), compress(runs, fine)) if len(t) > len(r)]
        known.update(self._encode_letters(self._unknown(set(compress(runs, fine)))))
        odd = [t for t, f in zip(texts, fine) if not f]
        known.update(self._encode_apart(self._unknown({*odd, *(e for _, _, e in pointed)})))
        known.update((t, known[r] + known[e]) for t, r, e in pointed)

    def ids(self, texts: list[bytes]) -> list[bytes]:
        held = [k for k, t in enumerate(texts) if self.added(t)]
        if not held:
            return self._ids(texts)
        out = self._ids([b"" if self.added(t) else t for t in texts])
        self.tokenizer.encode_special_tokens = False
        try:
            for k, ids in zip(held, self._encode([texts[k].decode() for k in held])):
                out[k] = np.array(ids, "<u4").tobytes()
        finally:
            self.tokenizer.encode_special_tokens = True
        return out

    def _cut(self, texts: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The distinct pieces of the texts, which of them each piece is, and how many pieces lie before each text and in all."""
        buf, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
        if self.drops_space:
            inside, start = ~SPACE[buf], np.zeros(len(buf) + 1, bool)
            start[1:-1] = ~inside[:-1]
            start[offsets] = True
            starts, buf = np.flatnonzero(inside & start[:-1]), buf[inside]
            bounds = np.flatnonzero(start[:-1][inside])
        else:
            bounds = starts = piece_starts(buf, offsets)
        sides = [pa.py_buffer(np.append(bounds, len(buf))), pa.py_buffer(buf)]
        found = pa.Array.from_buffers(pa.large_utf8(), len(bounds), [None, *sides]).dictionary_encode()
        return found.dictionary.to_numpy(zero_copy_only=False).tolist(), found.indices.to_numpy(), np.searchsorted(starts, offsets)

    def _ids(self, texts: list[bytes]) -> list[bytes]:
        gc.disable()  # many strings are kept and none of them form cycles
        try:
            pieces, which, first = self._cut(texts)
            if len(self.known) > self.memory // 2:
                self.known, self.older = {}, self.known
            found = list(map(self.known.get, pieces))
            new = [k for k, ids in enumerate(found) if ids is None]
            if new:
                self._learn(self._unknown([pieces[k] for k in new]))
                for k in new:
                    found[k] = self.known[pieces[k]]
            size = np.fromiter(map(len, found), np.int64, len(found)) // 4
            begin, count = (np.cumsum(size) - size)[which], size[which]
            ends = np.concatenate(([0], np.cumsum(count)))
            at = np.repeat(begin - ends[:-1], count)
            at += np.arange(len(at))
            ids = np.frombuffer(b"".join(found), "<u4")[at].tobytes()
            edges = (ends[first] * 4).tolist()
            return [ids[a:b] for a, b in zip(edges[:-1], edges[1:])]
        finally:
            gc.enable()


@lru_cache(maxsize=2)
def encoder(path: str, drops_space: bool) -> PieceEncoder:
    """The worker process's encoder: what one task has met the next one knows."""
    return PieceEncoder(path, drops_space)
