"""Exact BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word there is one last token that the BPE encoding of that prefix ends with. It is found
among the tokens that are suffixes of the prefix, which a suffix automaton over the vocabulary yields, and it is the
one whose pair with the last token of the rest is compatible: encoding the two tokens' joined symbols gives
back these two. Back-pointers from the whole word then give the ids, without any merge loop.

Words come from the vocabulary file's own normaliser and pre-tokenizer rules. Texts of common characters take a
fast way with the same result; texts with others, or with special tokens' strings, pass the library's normaliser and
pre-tokenizer, but never its BPE model.

Null and empty texts have no ids and decode to the empty string. Work for a word of n symbols is n times the tokens
that end at a place, so very long words stay linear.
"""

from __future__ import annotations

import gc
import json
import os
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_arrow, release_memory, sha256_hex, texts

_NEVER = 1 << 60


class SuffixAutomaton:
    """All substrings of the given strings; each token is the longest string of one state."""

    def __init__(self, tokens: dict[str, int]):
        own: list[dict[str, int]] = [{}]
        link, length = [-1], [0]
        token = [-1]
        for text, ident in tokens.items():
            last = 0
            for c in text:
                there = own[last].get(c)
                if there is not None and length[there] == length[last] + 1:
                    last = there
                    continue
                if there is not None:
                    last = self._copy(own, link, length, token, last, c, there)
                    continue
                new = len(own)
                own.append({})
                length.append(length[last] + 1)
                token.append(-1)
                p = last
                while p != -1 and c not in own[p]:
                    own[p][c] = new
                    p = link[p]
                if p == -1:
                    link.append(0)
                else:
                    q = own[p][c]
                    link.append(q)
                    if length[q] != length[p] + 1:
                        link[new] = self._copy(own, link, length, token, p, c, q)
                last = new
            token[last] = ident
        self.own, self.link, self.length, self.token = own, link, length, token
        #: The nearest state, this one or over suffix links, that is a whole token.
        self.hit = [-1] * len(own)
        for s in sorted(range(1, len(own)), key=length.__getitem__):
            self.hit[s] = s if token[s] >= 0 else self.hit[link[s]] if link[s] > 0 else -1

    @staticmethod
    def _copy(own, link, length, token, p, c, q) -> int:
        new = len(own)
        own.append(dict(own[q]))
        length.append(length[p] + 1)
        token.append(-1)
        link.append(link[q])
        link[q] = new
        while p != -1 and own[p].get(c) == q:
            own[p][c] = new
            p = link[p]
        return new


class PrefixBpe:
    """Encoder for a BPE vocabulary file of the tokenizers library whose words end in a marked symbol.

    ``max_pairs`` and ``max_words`` bound the tables of tested pairs and of encoded words; they are emptied when full.
    """

    def __init__(self, path: str, max_pairs: int = 150_000, max_words: int = 50_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        self.names = {i: t for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names |= {i: t for t, i in self.special.items()}
        self.symbols = {self._symbols(t): i for t, i in model["vocab"].items()}
        rank, parts = {}, {}
        self.joined: dict[tuple[int, int], int] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            a, b, whole = model["vocab"][a], model["vocab"][b], model["vocab"][a + b]
            if max(rank.get(a, -1), rank.get(b, -1)) >= r or whole in parts:
                raise ValueError("merges must come in the order in which their parts are made, once each")
            self.joined[a, b], rank[whole], parts[whole] = r, r, (a, b)
        self.rank, self.parts = rank, parts
        #: Right (1) and left (0) spines of the tokens that were asked for.
        self.spines: tuple[dict, dict] = ({}, {})
        self.automaton = SuffixAutomaton(self.symbols)
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, tuple[bytes, str]] = {}
        self.max_pairs, self.max_words = max_pairs, max_words

    def _symbols(self, token: str) -> str:
        """One character a symbol: the one that ends a word is moved out of the way."""
        if self.end and token.endswith(self.end) and token != self.end:
            token = token[: -len(self.end)]
            return token[:-1] + chr(ord(token[-1]) + 0x10000)
        return token

    def word_symbols(self, word: str) -> str:
        return word[:-1] + chr(ord(word[-1]) + 0x10000) if self.end else word

    def spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """(token, rank of the merge that takes it up within the whole) from the whole token down one side."""
        got = self.spines[side].get(token)
        if got is None:
            got, x, until = [], token, _NEVER
            while True:
                got.append((x, until))
                if x not in self.parts:
                    break
                until, x = self.rank[x], self.parts[x][side]
            self.spines[side][token] = got
        return got

    def compatible(self, a: int, b: int) -> bool:
        """Whether BPE of the symbols of a and b is a, b.

        A merge over the border takes x, now the right end of a's side, and y, the left end of b's. Its rank must
        come before x is taken up within a (there the one further left goes first if ranks are equal) and not after
        y is taken up within b.
        """
        joined = self.joined
        for x, x_until in self.spine(a, 1):
            for y, y_until in self.spine(b, 0):
                r = joined.get((x, y))
                if r is not None and r < x_until and r <= y_until:
                    return False
        return True

    def encode_symbols(self, s: str) -> list[int]:
        auto, pairs = self.automaton, self.pairs
        own, link, hit, length, token = auto.own, auto.link, auto.hit, auto.length, auto.token
        last = [0] * (len(s) + 1)
        back = [0] * (len(s) + 1)
        state = matched = 0
        for i, c in enumerate(s, 1):
            while True:
                there = own[state].get(c)
                if there is not None:
                    state = there
                    matched += 1
                    break
                if not state:
                    raise ValueError(f"no token for {c!r}")
                state = link[state]
                matched = length[state]
            at = hit[state]
            if at > 0 and length[at] > matched:  # the state's longest string is longer than what was read
                at = hit[link[at]]
            while at > 0:
                t, j = token[at], i - length[at]
                if not j:
                    break
                key = last[j] << 20 | t
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) >= self.max_pairs:
                        pairs.clear()
                    fits = pairs[key] = self.compatible(last[j], t)
                if fits:
                    break
                at = hit[link[at]]
            else:
                raise ValueError("no compatible last token")
            last[i], back[i] = t, j
        out, i = [], len(s)
        while i:
            out.append(last[i])
            i = back[i]
        return out[::-1]

    def encode_word(self, word: str) -> tuple[bytes, str]:
        """Little-endian 32-bit ids and the decoded tokens of one byte-level word."""
        ids = self.encode_symbols(self.word_symbols(word))
        return struct.pack(f"<{len(ids)}I", *ids), " ".join(map(self.names.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        """As the library's decode without a decoder: the tokens joined by spaces."""
        return " ".join(self.names[i] for i in ids if i in self.names)


def byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next free character from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


class TextEncoder:
    """Whole texts: normaliser, special tokens, pre-tokenizer and words."""

    #: Characters whose lower case and classes are the same in every Unicode version in use.
    COMMON = r"[\t\n\r -~\xa1-ɏ]*"
    #: The vocabulary file's own pattern of words. Fixed value.
    WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str, max_chunks: int = 250_000):
        import re

        import regex

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.bpe = PrefixBpe(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"]["pretokenizers"]
        if pre[0]["pattern"]["Regex"] != self.WORDS or [n["type"] for n in spec["normalizer"]["normalizers"]] != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("this vocabulary has other rules for words")
        self.path, self.lib = path, None
        self.common = re.compile(self.COMMON).fullmatch
        self.find = regex.compile(self.WORDS).findall
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.bpe.special)) + ")").split if self.bpe.special else lambda t: [t]
        self.letters = byte_letters()
        self.chunks: dict[str, tuple[bytes, str]] = {}
        self.max_chunks = max_chunks

    def _word(self, letters: str) -> tuple[bytes, str]:
        words = self.bpe.words
        got = words.get(letters)
        if got is None:
            if len(words) >= self.bpe.max_words:
                words.clear()
            got = words[letters] = self.bpe.encode_word(letters)
        return got

    def _join(self, words: list[str]) -> tuple[bytes, str]:
        if len(words) == 1:
            return self._word(words[0])
        got = [self._word(w) for w in words]
        return b"".join([g[0] for g in got]), " ".join([g[1] for g in got])

    def _chunk(self, chunk: str) -> tuple[bytes, str]:
        """A run without white space: a word, a word and a mark, or what the pattern finds."""
        get, letters = self.chunks.get, self.letters
        if chunk.isalpha():
            got = self._join(["".join([letters[b] for b in chunk.encode()])])
            if len(self.chunks) >= self.max_chunks:
                self.chunks.clear()
            self.chunks[chunk] = got
            return got
        if chunk[-1] in ".,!?:;" and chunk[:-1].isalpha():
            word, mark = chunk[:-1], chunk[-1]
            a, b = get(word) or self._chunk(word), self._word(mark)
            return a[0] + b[0], a[1] + " " + b[1]
        return self._join(["".join([letters[b] for b in w.encode()]) for w in self.find(chunk)])

    def _rare(self, text: str) -> tuple[bytes, str]:
        """The library's own normaliser and pre-tokenizer, for texts with characters out of the common."""
        if self.lib is None:
            from tokenizers import Tokenizer

            self.lib = Tokenizer.from_file(self.path)
        normal = self.lib.normalizer.normalize_str(text)
        return self._join([w for w, _ in self.lib.pre_tokenizer.pre_tokenize_str(normal)])

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian unsigned 32-bit integers, and the decoded text."""
        out: list[tuple[bytes, str]] = []
        for part in self.split_special(text) if "<|" in text else [text]:
            if part in self.bpe.special:
                out.append((struct.pack("<I", self.bpe.special[part]), part))
            elif self.common(part):
                get, make = self.chunks.get, self._chunk
                out += [get(c) or make(c) for c in part.lower().split()]
            elif part:
                out.append(self._rare(part))
        return b"".join([o[0] for o in out]), " ".join([o[1] for o in out if o[0]])


@lru_cache(maxsize=2)
def encoder_for(vocab: str, max_chunks: int = 250_000) -> TextEncoder:
    """One encoder a Python worker, for all its tasks."""
    encoder = TextEncoder(vocab, max_chunks)
    gc.collect()
    release_memory()
    return encoder


def encode_texts(docs: DataFrame, vocab: str) -> DataFrame:
    """doc_id, n_tokens, ids (array of int) and decoded text. No shuffle."""
    return _encoded(docs, vocab, "doc_id long, n_tokens long, ids array<int>, decoded string", _full)


def encode_digests(docs: DataFrame, vocab: str) -> DataFrame:
    """As encode_texts, with SHA-256 of the ids' bytes and of the decoded text in place of them."""
    return _encoded(docs, vocab, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", _digest)


def encode_ids(docs: DataFrame, vocab: str, max_chunks: int = 100_000) -> DataFrame:
    """As encode_texts, with SHA-256 of the decoded text in place of it. ``max_chunks`` bounds a worker's table of known runs."""
    return _encoded(docs, vocab, "doc_id long, n_tokens long, ids array<int>, decoded_sha256 string", _ids, max_chunks)


def decode_ids(encoded: DataFrame, vocab: str, ids_col: str = "ids") -> DataFrame:
    """doc_id and the decoded text of arrays of ids; null counts as empty, ids out of the vocabulary are left out."""

    def make():
        bpe = encoder_for(vocab).bpe

        def f(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([bpe.decode(x or []) for x in batch.column(ids_col).to_pylist()], pa.string())], ["doc_id", "decoded"])

        return f

    return map_arrow(encoded.select("doc_id", ids_col), make, "doc_id long, decoded string")


def _full(ids: bytes, decoded: str) -> tuple:
    return ids, decoded


def _ids(ids: bytes, decoded: str) -> tuple:
    return ids, sha256_hex(decoded.encode())


def _digest(ids: bytes, decoded: str) -> tuple:
    return sha256_hex(ids), sha256_hex(decoded.encode())


def id_lists(packed: list[bytes]) -> pa.ListArray:
    """Arrow lists over one buffer of 32-bit ids; no Python integers are made."""
    ends = np.cumsum([0, *map(len, packed)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), "<i4")))


def _encoded(docs: DataFrame, vocab: str, schema: str, shape, max_chunks: int = 250_000) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]
    first = id_lists if "array<int>" in schema else pa.array

    def make():
        encoder = encoder_for(vocab, max_chunks)

        def f(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, a, b = [], [], []
            for text in batch.column("text"):
                ids, decoded = encoder.encode(text.as_py())
                n.append(len(ids) // 4)
                x, y = shape(ids, decoded)
                a.append(x)
                b.append(y)
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), first(a), pa.array(b, pa.string())], names)

        return f

    return map_arrow(texts(docs), make, schema)
