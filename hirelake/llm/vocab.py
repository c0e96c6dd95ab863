"""Public tokenizers inside Python tasks: loaded once per worker, with bounded memories of what was encoded."""

import base64
import functools
import re

import numpy as np
import public_tokenizers

from hirelake.llm import common

#: Words remembered per generation; a worker holds two generations at most, of about 200 bytes a word.
REMEMBERED = 400_000
PIECES_REMEMBERED = 150_000
#: Unicode white space, and the control characters that str.split() takes for it but Unicode does not.
UNICODE_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
#: ASCII signs that no letter joins with.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
NOT_SPACE = re.compile("[\x1c-\x1f]")


def ids_to_bytes(ids) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


class Memory(dict):
    """key -> value(key), forgetting what was not asked for of late. `memory[key]` is all callers need."""

    def __init__(self, value, limit: int = REMEMBERED):
        super().__init__()
        self.value, self.limit, self.old = value, limit, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.value(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


@functools.lru_cache(maxsize=2)
def rank_file(name: str) -> dict[bytes, int]:
    """Byte sequence -> rank of a file of ranks."""
    with open(public_tokenizers.path(name), "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@functools.lru_cache(maxsize=2)
def word_tokenizer(name: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


@functools.lru_cache(maxsize=2)
def piece_tokenizer(name: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))


class WordMemory(Memory):
    """White-space-free text -> its ids as bytes, for a lower-casing tokenizer of words.

    White space always separates this tokenizer's words, so a text's ids are those of its runs without white space, one after the
    other. It splits letters from signs, so a run of letters and signs is looked up as two. Latin letters are
    looked up in lower case. New runs of letters are encoded many at a time.
    """

    TOGETHER = 1000

    def __init__(self, name: str):
        super().__init__(self._encode)
        self.tokenizer = word_tokenizer(name)

    def _encode(self, run: str) -> bytes:
        stem, sign = self._stem(run)
        if stem == run:
            return ids_to_bytes(self.tokenizer.encode(run, add_special_tokens=False).ids)
        return self[stem] + self[sign] if sign else self[stem]

    @staticmethod
    def _stem(run: str) -> tuple[str, str]:
        """Lower-case letters and the signs after them; the run itself if it is anything else."""
        stem = run.rstrip(SIGNS)
        low = stem.lower()
        if not low.isalpha() or (not low.isascii() and max(low) >= "\u0250"):
            return run, ""
        return low, run[len(stem) :]

    def learn(self, runs) -> None:
        """Encode the letters of runs not met before, many in one call."""
        old = self.old
        stems = {self._stem(r)[0] for r in runs if r not in self and r not in old}
        stems = [s for s in stems if s not in self and s not in old and s.isalpha() and s.islower() and max(s) < "\u0250"]
        for at in range(0, len(stems), self.TOGETHER):
            some = stems[at : at + self.TOGETHER]
            encoded = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            words = np.array(encoded.word_ids, dtype=np.int64)
            ids = np.array(encoded.ids, dtype="<u4")
            edges = np.flatnonzero(np.diff(words, prepend=-1, append=-1))
            if len(edges) != len(some) + 1:  # some word is more than one to the tokenizer: each by itself, when asked for
                continue
            data = ids.tobytes()
            for stem, a, b in zip(some, (4 * edges[:-1]).tolist(), (4 * edges[1:]).tolist()):
                self[stem] = data[a:b]


@functools.lru_cache(maxsize=2)
def word_memory(name: str) -> WordMemory:
    return WordMemory(name)


common.HELD += [word_memory, word_tokenizer]


def runs_of(text: str) -> list[str]:
    return text.split() if not NOT_SPACE.search(text) else [r for r in UNICODE_SPACE.split(text) if r]


def word_ids(memory: WordMemory, texts: list[str]) -> list[bytes]:
    """Ids of each whole text as little-endian unsigned 32-bit integers."""
    runs = [runs_of(t) for t in texts]
    memory.learn(set().union(*runs))
    return [b"".join(map(memory.__getitem__, r)) for r in runs]
