"""Token ids of whole texts with the tokenizers library, a word at a time.

The vocabulary drops white space and never merges across it, so a text's ids
are its white-space-separated words' ids joined.  Words repeat far more often
than texts do: each worker keeps a bounded table word -> ids and sends only
unknown words to the library.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np

#: Words of a worker's table before it is begun anew; the one before is kept beside it.
MAX_WORDS = 500_000
#: Longer words go to the library without being kept.
MAX_WORD_CHARS = 200
#: Characters of texts, about, whose words are looked up at once.
CHUNK_CHARS = 2_000_000
#: Marks that are pieces of their own after a word; letters below LATIN_END have one-to-one lower cases.
MARKS = ".,;:!?"
LATIN_END = "\u0250"
#: The pieces that a vocabulary's pattern makes of a text, and the same for lower-case printable ASCII.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")

_ENCODERS: dict[str, "WordEncoder"] = {}


def encoder(path: str) -> "WordEncoder":
    """This worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


class WordEncoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.marks = {m: self._direct([m])[0] for m in ["", *MARKS]}
        # ids that end a word, where the vocabulary marks them
        suffix = getattr(self.tok.model, "end_of_word_suffix", None)
        self.ends = None
        if suffix:
            vocab = self.tok.get_vocab(with_added_tokens=True)
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.plain = self._takes_plain_words()

    def _direct(self, texts: list[str]) -> list[bytes]:
        out = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in out]

    def _takes_plain_words(self) -> bool:
        """Whether the library's model alone gives the ids of a piece of lower-case
        printable ASCII: the vocabulary splits by ``SPLIT``, nothing else in it
        changes such a piece, and its added tokens all have a "<"."""
        if self.ends is None or not all("<" in x.content for x in self.tok.get_added_tokens_decoder().values()):
            return False
        steps = json.loads(self.tok.pre_tokenizer.__getstate__()).get("pretokenizers", [])
        if [(x["type"], x.get("pattern", {}).get("Regex")) for x in steps] != [("Split", SPLIT), ("ByteLevel", None)]:
            return False
        printable = "".join(map(chr, range(0x21, 0x7F))).lower()
        tried = sorted({x for i in range(len(printable)) for x in ASCII_SPLIT.findall(printable[i:] + printable[:i])})
        return self._modelled(tried) == self._direct(tried)

    def _modelled(self, words: list[str]) -> list[bytes]:
        pieces = self.tok.model.tokenize
        return [array("I", [x.id for x in pieces(w)]).tobytes() for w in words]

    def _stems(self, stems: list[str]) -> list[bytes]:
        """Ids of lower-case words of letters alone, or other pieces of ASCII.
        Those of ASCII are one piece for the library's model; others go through
        the whole library, many in one call: such a word is one piece, so its
        last id, and no other, ends a word."""
        if self.plain:
            rest = [s for s in stems if not s.isascii()]
            if len(rest) < len(stems):
                ids = iter(self._stems(rest) if rest else ())
                ascii_ids = iter(self._modelled([s for s in stems if s.isascii()]))
                return [next(ascii_ids if s.isascii() else ids) for s in stems]
        if self.ends is None:
            return self._direct(stems)
        out: list[bytes] = []
        for lo in range(0, len(stems), 2000):
            some = stems[lo:lo + 2000]
            data = self._direct([" ".join(some)])[0]
            at = [0, *((np.flatnonzero(self.ends[np.frombuffer(data, "<u4")]) + 1) * 4).tolist()]
            out += [data[a:b] for a, b in zip(at, at[1:])] if len(at) == len(some) + 1 else self._direct(some)
        return out

    def _learn(self, words: list[str]) -> None:
        """Adds the words to the table.  One of Latin letters, with or without
        a mark after it, is its lower-case stem's ids and the mark's; another of
        printable ASCII is its pieces' ids."""
        known, whole, stems, tails, rest, split = self.known, [], [], [], [], {}
        for w in words:
            tail = w[-1]
            if tail in MARKS:
                body = w[:-1]
            else:
                body, tail = w, ""
            if body.isalpha() and (body.isascii() or max(body) < LATIN_END):
                whole.append(w)
                stems.append(body.lower())
                tails.append(tail)
            elif self.plain and w.isascii() and w.isprintable() and "<" not in w and len(w) <= MAX_WORD_CHARS:
                split[w] = ASCII_SPLIT.findall(w.lower())
            else:
                rest.append(w)
        new = list(self._recall(set(stems).union(*split.values())))
        known.update(zip(new, self._stems(new)))
        known.update(zip(rest, self._direct(rest)))
        marks, get = self.marks, known.__getitem__
        known.update((w, known[s] + marks[t]) for w, s, t in zip(whole, stems, tails))
        known.update((w, b"".join(map(get, x))) for w, x in split.items())

    def _recall(self, words: set[str]) -> set[str]:
        """The words that aren't known; those known before the table was begun anew are taken over."""
        new = words.difference(self.known)
        back = self.before.keys() & new
        self.known.update((w, self.before[w]) for w in back)
        return new - back

    def _chunks(self, texts: list[str], odd: set[int]) -> Iterator[list[int]]:
        part, held = [], 0
        for i, t in enumerate(texts):
            if i not in odd:
                part.append(i)
                held += len(t)
            if held > CHUNK_CHARS:
                yield part
                part, held = [], 0
        if part:
            yield part

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """uint32 ids of each text."""
        # str.split also cuts at 0x1C-0x1F, which the vocabulary keeps: such texts go whole
        odd = {i for i, t in enumerate(texts) if any(c in t for c in ("\x1c", "\x1d", "\x1e", "\x1f"))}
        out: list[np.ndarray | None] = [None] * len(texts)
        for i in odd:
            out[i] = np.frombuffer(self._direct([texts[i]])[0], "<u4")
        for part in self._chunks(texts, odd):
            words = [texts[i].split() for i in part]
            if len(self.known) > MAX_WORDS:
                self.known, self.before = {}, self.known
            unknown = list(self._recall(set().union(*words)))
            self._learn(unknown)
            get = self.known.__getitem__
            for i, w in zip(part, words):
                out[i] = np.frombuffer(b"".join(map(get, w)), "<u4")
            for w in unknown:
                if len(w) > MAX_WORD_CHARS:
                    del self.known[w]
        return out
