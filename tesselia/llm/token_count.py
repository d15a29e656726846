"""Token counts: exact lengths as the tokenizers library gives them.

Texts are cut at safe boundaries: a single space between two other characters that are no white space. A
byte-level tokenizer's pre-tokens start at every such space and never reach over it, so the count of a text is
the sum over its pieces. The pieces of about 2 MB of texts that are not yet known are gathered, and go to the library's batch calls
in lists of equal bytes; a bounded table of known pieces lasts as long as the Python worker. Only lengths leave the function.

Null and empty texts have no tokens. Very long texts are cut like all others, so no task encodes one as a whole.
A special token's string in a text counts as the library's default has it, as one token. Repeated rows are each counted, an empty
table gives no rows, and other columns may have any names. A vocabulary with other rules for words is refused.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import map_arrow, slices, texts

#: White space other than a plain space, wherever the library's pattern may see it. Fixed values.
_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0  -     　"
_ODD = re.compile(f"  |[{_SPACE}] | [{_SPACE}]|^ | $")
_SAFE = re.compile(f"(?<=[^ {_SPACE}]) (?=[^ {_SPACE}])")


def pieces_of(text: str) -> list[str]:
    """The text cut before each safe space; the space itself is left out, so each piece but the first lost one."""
    return _SAFE.split(text) if _ODD.search(text) else text.split(" ")


class Counter:
    """Counts tokens; ``known`` is bounded by ``max_known`` pieces and emptied when full."""

    def __init__(self, path: str, max_known: int = 600_000, batch_bytes: int = 1 << 16, batch_texts: int = 8):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_padding()
        self.lib.no_truncation()
        spec = json.loads(self.lib.to_str())
        pre = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) or pre.get("add_prefix_space"):
            raise ValueError("texts are cut at spaces for byte-level vocabularies with the library's pattern and no normaliser only")
        if any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("a special token of this vocabulary reaches over spaces")
        self.batch_texts = batch_texts
        self.known: dict[str, int] = {}
        self.max_known, self.batch_bytes = max_known, batch_bytes

    def lengths(self, pieces: list[str]) -> list[int]:
        """Token counts of pieces, each behind a space, in texts of about ``batch_bytes`` for the library.

        Joined by spaces they are cut at the same safe boundaries again; a token belongs to the piece it starts in.
        """
        lists, size = [[]], 0
        for p in pieces:
            if size >= self.batch_bytes:
                lists.append([])
                size = 0
            lists[-1].append(p)
            size += len(p) + 1
        out = []
        for at in range(0, len(lists), self.batch_texts):
            some = [x for x in lists[at : at + self.batch_texts] if x]
            for own, e in zip(some, self.lib.encode_batch([" " + " ".join(x) for x in some], add_special_tokens=False)):
                starts = np.cumsum([0] + [len(x) + 1 for x in own])
                begins = np.fromiter((o[0] for o in e.offsets), np.int64, len(e))
                out += np.diff(np.searchsorted(begins, starts)).tolist()
        return out

    def count(self, texts: list[str]) -> list[int]:
        """Token counts of texts; what is new in all of them together goes to the library."""
        cut = [pieces_of(t) for t in texts]
        new = {p for pieces in cut for p in pieces[1:]}
        if len(self.known) + len(new) > self.max_known:
            self.known.clear()
        new = [p for p in new if p not in self.known]
        self.known.update(zip(new, self.lengths(new)))
        heads = list({pieces[0] for pieces in cut})
        first = {p: len(e) for p, e in zip(heads, self.lib.encode_batch_fast(heads, add_special_tokens=False))}
        return [first[pieces[0]] + sum(map(self.known.__getitem__, pieces[1:])) for pieces in cut]


@lru_cache(maxsize=2)
def counter_for(vocab: str, max_known: int) -> Counter:
    """One counter a Python worker, for all its tasks."""
    return Counter(vocab, max_known)


def count_tokens(docs: DataFrame, vocab: str, limit: int = 512, max_known: int = 600_000) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of each text. No shuffle."""

    def make():
        counter = counter_for(vocab, max_known)

        def f(batch: pa.RecordBatch) -> pa.RecordBatch:
            n: list[int] = []
            for part in slices(batch, most=1 << 21):
                n += counter.count(part.column("text").to_pylist())
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pc.binary_length(batch.column("text")).cast(pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

        return f

    return map_arrow(texts(docs), make, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
