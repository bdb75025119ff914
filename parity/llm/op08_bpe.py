"""BPE encoding and decoding with a pair occurrence index.

The distinct words that a worker hasn't met yet are laid out as one array of
symbols.  An index maps every adjacent pair (by its merge rank) to all its
positions in that array.  Active ranks are taken in ascending order from a
heap; all occurrences of the pair are merged at once, and the lists of the
pairs that thereby come to stand left and right are extended.  Entries that a
merge has overtaken are recognised when their list is applied.

A text's ids are its words' ids joined, since merges never cross white space.
Splitting follows the vocabulary file: special tokens in the raw text first,
then NFC, lower case, and its pattern (beyond ASCII the file's own normalizer
and pattern are called, for their Unicode tables).  Decoding joins the ids' token strings
with a space, which is what a tokenizer without a decoder does.

Nulls, ties, emptiness: a null text is empty (no ids, empty decoded text); a
null doc_id stays null; repeated rows each give their row; an empty table
gives no rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from parity.llm import common

#: Words kept by a worker before its table is begun anew (bounds its memory).
MAX_WORDS = 800_000
MAX_WORD_CHARS = 200
#: Characters of unknown words laid out at once (about).
MAX_SYMBOLS = 4_000_000

DIGEST = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                    ("decoded_sha256", pa.string())])

_CODECS: dict[str, "PairIndexBpe"] = {}


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1
    characters for themselves, the others from code point 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(own))}
    return [rest.get(b, chr(b)) for b in range(256)]


class PairIndexBpe:
    def __init__(self, path: str) -> None:
        import regex
        from tokenizers import Regex, Tokenizer, pre_tokenizers
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # the file's own normalizer and pattern split words beyond ASCII, so that the
        # Unicode tables behind them are the library's
        self.normalizer = Tokenizer.from_file(path).normalizer
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern)
        self.splitter = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")")
        size = max([*vocab.values(), *self.special.values()]) + 1
        strings = [""] * size
        for s, i in [*vocab.items(), *self.special.items()]:
            strings[i] = s
        self.token_bytes = [s.encode("utf-8") for s in strings]
        chars = byte_characters()
        self.inner = np.array([vocab[c] for c in chars], np.int64)
        self.final = np.array([vocab[c + suffix] for c in chars], np.int64)
        self.size = size
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.left = np.array([vocab[a] for a, _ in pairs], np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = self.left * size + self.right
        self.rank_of = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_of]
        self.known: dict[str, bytes] = {}

    # -- splitting ---------------------------------------------------------

    def parts(self, word: str) -> list[str | int]:
        """Pieces (text) and special ids (int) of a word without white space."""
        if word.isascii() and word.isalpha():
            return [word.lower()]
        out: list[str | int] = []
        for bit in self.special_at.split(word) if "<|" in word else [word]:
            if bit in self.special:
                out.append(self.special[bit])
            elif bit.isascii():
                out += self.pattern.findall(bit.lower())
            elif bit:
                out += [p for p, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(bit))]
        return out

    # -- the index ---------------------------------------------------------

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, or -1."""
        want = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.rank_of[at], -1)

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces joined, where each begins and the end)."""
        raw = [p.encode("utf-8") for p in pieces]
        ends = np.cumsum([len(r) for r in raw])
        data = np.frombuffer(b"".join(raw), np.uint8)
        n = len(data)
        sym = self.inner[data]
        sym[ends - 1] = self.final[data[ends - 1]]
        nxt = np.arange(1, n + 1)
        nxt[ends - 1] = -1
        prv = np.arange(-1, n - 1)
        prv[np.concatenate([[0], ends[:-1]])] = -1

        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def extend(at: np.ndarray, ranks: np.ndarray) -> None:
            has = ranks >= 0
            at, ranks = at[has], ranks[has]
            if not len(at):
                return
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for rank, some in zip(ranks[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts)):
                if rank in index:
                    index[rank].append(some)
                else:
                    index[rank] = [some]
                    heapq.heappush(active, rank)

        at = np.flatnonzero(nxt >= 0)
        extend(at, self._ranks(sym[at], sym[at + 1]))
        while active:
            rank = heapq.heappop(active)
            lists = index.pop(rank)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            a, b, new = self.left[rank], self.right[rank], self.made[rank]
            other = nxt[at]
            holds = (sym[at] == a) & (other >= 0) & (sym[other] == b)
            at, other = at[holds], other[holds]
            if a == b and len(at) > 1:
                # a a a: the leftmost of overlapping occurrences, then every second of the run
                begins = np.concatenate([[True], other[:-1] != at[1:]])
                first = np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
                even = (np.arange(len(at)) - first) % 2 == 0
                at, other = at[even], other[even]
            if not len(at):
                continue
            after = nxt[other]
            sym[at], sym[other], nxt[at] = new, -1, after
            has = after >= 0
            prv[after[has]] = at[has]
            before = prv[at]
            left, right = before[before >= 0], at[has]
            extend(np.concatenate([left, right]),
                   self._ranks(np.concatenate([sym[left], sym[right]]),
                               np.concatenate([sym[nxt[left]], sym[nxt[right]]])))
        alive = sym >= 0
        return sym[alive], np.concatenate([[0], np.cumsum(alive)[ends - 1]])

    # -- words and texts ---------------------------------------------------

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids (uint32 bytes) of each word."""
        out: dict[str, bytes] = {}
        lo = 0
        while lo < len(words):
            hi, chars = lo, 0
            while hi < len(words) and chars < MAX_SYMBOLS:
                chars += len(words[hi])
                hi += 1
            split = [self.parts(w) for w in words[lo:hi]]
            pieces = list({p for x in split for p in x if isinstance(p, str)})
            ids_of: dict[str | int, bytes] = {i: np.uint32(i).tobytes() for i in self.special.values()}
            if pieces:
                ids, at = self.encode_pieces(pieces)
                data, at = ids.astype("<u4").tobytes(), (at * 4).tolist()
                ids_of.update((p, data[x:y]) for p, x, y in zip(pieces, at, at[1:]))
            out.update((w, b"".join(map(ids_of.__getitem__, x))) for w, x in zip(words[lo:hi], split))
            lo = hi
        return out

    @staticmethod
    def split(text: str) -> list[str]:
        """White-space-separated words (0x1C-0x1F aren't white space here)."""
        if any(c in text for c in ("\x1c", "\x1d", "\x1e", "\x1f")):
            import regex
            return regex.split(r"[^\S\x1c-\x1f]+", text)
        return text.split()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        words = [self.split(t) for t in texts]
        unknown = list({w for x in words for w in x}.difference(self.known))
        if len(self.known) + len(unknown) > MAX_WORDS:
            self.known = {}
            unknown = list({w for x in words for w in x})
        self.known.update(self._learn(unknown))
        get = self.known.__getitem__
        out = [np.frombuffer(b"".join(map(get, x)), "<u4") for x in words]
        for w in unknown:
            if len(w) > MAX_WORD_CHARS:
                del self.known[w]
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The decoded text in UTF-8."""
        return b" ".join(map(self.token_bytes.__getitem__, ids.tolist()))


def codec(path: str) -> PairIndexBpe:
    if path not in _CODECS:
        _CODECS[path] = PairIndexBpe(path)
    return _CODECS[path]


def round_trip(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """One row a document: number and digest of its ids, digest of what they decode to."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(vocabulary_path)
        for batch in parts:
            for lo in range(0, batch.num_rows, 4096):
                some = batch.slice(lo, 4096)
                rows: dict[str, list] = {f.name: [] for f in DIGEST}
                for doc_id, ids in zip(some.column(0).to_pylist(), bpe.encode(list(common.texts(some)))):
                    for k, v in zip(rows, (doc_id, len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
                                           hashlib.sha256(bpe.decode(ids)).hexdigest())):
                        rows[k].append(v)
                yield common.batches(rows, DIGEST)

    return common.doc_columns(docs).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return round_trip(common.read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
