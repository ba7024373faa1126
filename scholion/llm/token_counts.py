"""Token counts that follow edits without encoding the text anew.

A document's pre-tokens lie in the leaves of a segment tree whose nodes hold sums of characters
and tokens. An edit is found by its position; pre-tokens are split again from the one that touches
it to the first start behind it that the old text had too, only new ones are encoded, and the sums
above the changed leaves are brought up to date.

Defined cases: null texts count as empty; positions and lengths beyond the text are drawn in, null
or negative ones count as 0; null insertions are empty; no edits (or null) leave the count as it is;
repeated rows each get their result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholion.llm.bpe import Vocabulary, vocabulary

#: Pre-tokens of a leaf, and pre-tokens behind an edit that are looked at first.
LEAF, AHEAD = 64, 8
EDITS = "array<struct<at:bigint,removed:bigint,inserted:string>>"


class TokenTree:
    """Segment tree over the pre-tokens of a text."""

    def __init__(self, words: Vocabulary, text: str):
        self.words, self.encoded = words, 0
        self._build(words.pre_tokens(text))

    def _build(self, found: list[str]) -> None:
        self.leaves = [found[i:i + LEAF] for i in range(0, len(found), LEAF)] or [[]]
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for i in range(len(self.leaves)):
            self._count(i)
        for node in range(self.width - 1, 0, -1):
            self._sum(node)

    def _count(self, leaf: int) -> None:
        pieces = self.leaves[leaf]
        self.chars[self.width + leaf] = sum(map(len, pieces))
        self.tokens[self.width + leaf] = sum(len(x) for x in self.words.ids(pieces)) // 4

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    def _leaf_at(self, at: int) -> tuple[int, int]:
        """The leaf that holds the character at a position, and where the leaf starts."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if at >= start + self.chars[node]:
                start += self.chars[node]
                node += 1
        return min(node - self.width, len(self.leaves) - 1), start

    def _before(self, at: int) -> tuple[int, int, int]:
        """Leaf, place in it and position of the pre-token to split from.

        A pre-token looks at most at the one behind it and at one character more, so that is the
        pre-token before the first one that reaches the edit.
        """
        leaf, start = self._leaf_at(max(at - 1, 0))
        reached = 0
        while reached < len(self.leaves[leaf]) and start + len(self.leaves[leaf][reached]) < at:
            start += len(self.leaves[leaf][reached])
            reached += 1
        while not reached and leaf:
            leaf -= 1
            reached = len(self.leaves[leaf])
        if reached:
            reached -= 1
            start -= len(self.leaves[leaf][reached])
        return leaf, reached, start

    def edit(self, at: int | None, removed: int | None, inserted: str | None) -> None:
        at = min(max(at or 0, 0), self.n_chars)
        removed, inserted = min(max(removed or 0, 0), self.n_chars - at), inserted or ""
        if not removed and not inserted:
            return
        first, keep, start = self._before(at)
        last, pieces, reach = first, list(self.leaves[first][keep:]), AHEAD
        end = start + sum(map(len, pieces))
        while True:
            while last + 1 < len(self.leaves) and (end < at + removed or len(pieces) < reach):
                last += 1
                pieces += self.leaves[last]
                end += sum(map(len, self.leaves[last]))
            old = "".join(pieces)
            new = self.words.pre_tokens(old[:at - start] + inserted + old[at - start + removed:])
            meeting = self._meeting(pieces, new, start, at, removed, len(inserted), last + 1 == len(self.leaves))
            if meeting is not None:
                break
            reach = 2 * max(reach, len(pieces))
            if last + 1 < len(self.leaves):  # look further on
                last += 1
                pieces += self.leaves[last]
                end += sum(map(len, self.leaves[last]))
        old_kept, new_used = meeting
        fresh = new[:new_used]
        self.encoded += len(fresh)
        merged = self.leaves[first][:keep] + fresh + pieces[old_kept:]
        self._put(first, last, merged)

    @staticmethod
    def _meeting(pieces: list[str], new: list[str], start: int, at: int, removed: int, added: int, whole: bool) -> tuple[int, int] | None:
        """Numbers of old and new pre-tokens before the first start behind the edit that both share.

        The last pre-token of either may go on beyond what was looked at; its start is sure.
        """
        shift = added - removed
        old_starts, p = [], start
        for x in pieces:
            old_starts.append(p + shift)
            p += len(x)
        if whole:
            old_starts.append(p + shift)
        p = start
        for k, x in enumerate([*new, ""] if whole else new):
            if p >= at + added:
                i = bisect_left(old_starts, p)
                if i < len(old_starts) and old_starts[i] == p and p - shift >= at + removed:
                    return i, k
            p += len(x)
        return None

    def _put(self, first: int, last: int, merged: list[str]) -> None:
        """The pre-tokens of these leaves from now on; leaves that outgrow the tree build it anew."""
        room = last - first + 1
        size = max(LEAF, -(-len(merged) // room))
        if size > 4 * LEAF:
            self._build([x for leaf in self.leaves[:first] for x in leaf] + merged + [x for leaf in self.leaves[last + 1:] for x in leaf])
            return
        nodes = set()
        for k in range(room):
            self.leaves[first + k] = merged[k * size:(k + 1) * size]
            self._count(first + k)
            nodes.add((self.width + first + k) // 2)
        while nodes and nodes != {0}:
            for node in nodes:
                self._sum(node)
            nodes = {n // 2 for n in nodes} - {0}


def count(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text", edits: str = "edits") -> DataFrame:
    """One row per document: key, tokens_before, tokens_after, n_edits, n_pretokens, n_encoded, chars_after.

    ``edits`` is an array of (at, removed, inserted) in order, each on the text that the earlier
    ones left. n_encoded counts the pre-tokens that the edits split and encoded anew. A document
    stays in its row and its tree lives while the row is worked on.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       F.coalesce(F.col(edits).cast(EDITS), F.array().cast(EDITS)).alias("edits"))
    kind = rows.schema["key"].dataType.simpleString()

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(ranks, pattern)
        for batch in batches:
            found = []
            for k, body, changes in zip(*batch.columns):
                tree = TokenTree(words, body.as_py())
                before = tree.n_tokens
                done = [e for e in changes.as_py() if e is not None]
                for e in done:
                    tree.edit(e["at"], e["removed"], e["inserted"])
                found.append((k.as_py(), before, tree.n_tokens, len(done), sum(map(len, tree.leaves)), tree.encoded, tree.n_chars))
            names = ["key", "tokens_before", "tokens_after", "n_edits", "n_pretokens", "n_encoded", "chars_after"]
            columns = list(zip(*found)) if found else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], batch.schema.field(0).type)] + [pa.array(c, pa.int64()) for c in columns[1:]], names)

    return rows.mapInArrow(counts, f"key {kind}, tokens_before long, tokens_after long, n_edits long, n_pretokens long, n_encoded long, chars_after long"
                           ).withColumnRenamed("key", key)


def with_edits(docs: DataFrame, edits: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents with their rows of ``edits`` (key, seq, at, removed, inserted) as an array in order of seq."""
    logs = edits.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("seq", "at", "removed", "inserted"))).alias("log"))
    steps = logs.select(key, F.transform("log", lambda e: F.struct(e["at"], e["removed"], e["inserted"])).cast(EDITS).alias("edits"))
    return docs.join(steps, key, "left")
