"""Token counts by prefix dynamic programming.

Byte-pair encoding has an optimal-substructure form: the encoding of a symbol prefix ends in exactly one token
``t`` such that the encoding of what precedes it ends in a token compatible with ``t`` (the two, joined and
encoded afresh, split back into the same two).  So one left-to-right pass stores, for every prefix of a word, its
last token and its token count; the end-of-word variant of any prefix is one more step from the stored states.
A text's table is the running sum over its words, with their places in the source (of any script), and answers "how
many tokens has text[:p]" and "which prefix fits a budget" without encoding anything again.  Workers keep their tables
by path.

Defined results: null text counts as empty (0 bytes, 0 tokens); repeated rows give repeated rows; an empty table
gives an empty result; extra columns are ignored by the query and never read.
"""

from __future__ import annotations

import bisect
import functools
import json
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_text

#: Characters on which plain ``re`` classes and ``str.lower`` agree with the library's Unicode rules; no character
#: of this range composes with another.  Texts with others go through the library's own normaliser.
_PLAIN = re.compile("[\t\n\r -~¡-įı-ž‐-‧]*")
_L, _N = "a-zªµºß-öø-ž", "0-9²³¹¼-¾"
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\\s{_L}{_N}]+")
#: Memo entries kept by one worker; a full memo is emptied, which costs time and never changes a count.
MEMO = 400_000
#: Symbols from which on a word's states are kept by place for the time being, and not by prefix.
LONG = 256
#: Characters of a long text whose words are looked up at a time.
STRETCH = 1 << 14


def _byte_alphabet() -> list[str]:
    """The printable stand-ins of byte-level vocabularies: printable bytes stay, the rest count up from 256."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


class PrefixBpe:
    """Exact token counts of every prefix of a word."""

    END = "</w>"

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != self.END:
            raise ValueError("a BPE vocabulary with word ends is needed")
        self.vocab = set(model["vocab"])
        self.rank = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
        #: token -> (rank, left part, right part) of the merge that makes it
        self.made = {a + b: (i, a, b) for (a, b), i in sorted(self.rank.items(), key=lambda x: -x[1])}
        self.longest = max(len(v.removesuffix(self.END)) for v in self.vocab)
        self.alphabet = _byte_alphabet()
        self.special = [x["content"] for x in spec["added_tokens"]]
        self.special_re = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.library = Tokenizer.from_file(path)
        self._pair: dict[tuple[str, str], bool] = {}
        self._solid: dict[str, bool] = {}
        self._state: dict[str, tuple[str, int]] = {}
        self._word: dict[str, int] = {}
        self._levelled: dict[str, int] = {}

    def _apart(self, left: str, right: str) -> bool:
        """Whether merging never crosses the border of two tokens.

        Their merges are undone, latest first (of equal ones the right one, as merging goes from the left); the
        tokens at the border must at no time have been a pair that merges before what was undone.
        """
        rank, made = self.rank, self.made
        limit = 1 << 60
        while True:
            if rank.get((left, right), limit) < limit:
                return False
            a, b = made.get(left), made.get(right)
            if a is None and b is None:
                return True
            if b is None or a is not None and a[0] > b[0]:
                limit, left = a[0], a[2]
            else:
                limit, right = b[0] + 1, b[1]

    def _is_solid(self, token: str) -> bool:
        got = self._solid.get(token)
        if got is None:
            made = self.made.get(token)
            got = self._solid[token] = made is None or self._is_solid(made[1]) and self._is_solid(made[2]) and self._apart_but_last(made)
        return got

    def _apart_but_last(self, made: tuple[int, str, str]) -> bool:
        """Whether the two parts of a token come to stand side by side, and so are merged by its own rule."""
        rank, left, right = made
        held = self.rank.pop((left, right))
        try:
            return self._apart(left, right)
        finally:
            self.rank[left, right] = held

    def _fits(self, left: str, right: str) -> bool:
        got = self._pair.get((left, right))
        if got is None:
            if len(self._pair) > MEMO:
                self._pair.clear()
            got = self._pair[left, right] = self._apart(left, right)
        return got

    def _step(self, word: str, i: int, end: str) -> tuple[str, int]:
        """Last token and count of word[:i] (+ end), from the stored states of shorter prefixes."""
        vocab, state = self.vocab, self._state
        for start in range(max(0, i - self.longest), i):
            token = word[start:i] + end
            if token in vocab and self._is_solid(token):
                if not start:
                    return token, 1
                last, n = state[word[:start]]
                if self._fits(last, token):
                    return token, n + 1
        raise ValueError(f"no token ends {word[:i]!r}")

    def _fill(self, word: str, upto: int) -> None:
        state = self._state
        known = upto
        while known and word[:known] not in state:
            known -= 1
        for i in range(known + 1, upto + 1):
            state[word[:i]] = self._step(word, i, "")

    def _walk(self, word: str) -> list[tuple[str, int]]:
        """Last token and count of every prefix of a long word, by place: nothing of it is kept."""
        vocab, found = self.vocab, [("", 0)]
        for i in range(1, len(word)):
            for start in range(max(0, i - self.longest), i):
                token = word[start:i]
                if token in vocab and self._is_solid(token) and (not start or self._fits(found[start][0], token)):
                    found.append((token, found[start][1] + 1))
                    break
            else:
                raise ValueError(f"no token ends a prefix of {i} symbols")
        return found

    def _closed(self, word: str, found: list[tuple[str, int]], i: int) -> int:
        """Tokens of word[:i] as a word of its own, from the states of its prefixes."""
        for start in range(max(0, i - self.longest), i):
            token = word[start:i] + self.END
            if token in self.vocab and self._is_solid(token) and (not start or self._fits(found[start][0], token)):
                return found[start][1] + 1
        raise ValueError(f"no token ends a word of {i} symbols")

    def levelled_counts(self, word: str) -> list[int]:
        """Tokens of every prefix (1..n symbols) of a word in the byte alphabet, each taken as a word of its own."""
        if len(word) > LONG:
            found = self._walk(word)
            return [self._closed(word, found, i) for i in range(1, len(word) + 1)]
        if len(self._state) > MEMO:
            self._state.clear()
        self._fill(word, len(word) - 1)
        return [self._step(word, i, self.END)[1] for i in range(1, len(word) + 1)]

    def _count_levelled(self, word: str) -> int:
        if len(word) > LONG:
            return self._closed(word, self._walk(word), len(word))
        n = self._levelled.get(word)
        if n is None:
            if len(self._levelled) > MEMO:
                self._levelled.clear()
            if len(self._state) > MEMO:
                self._state.clear()
            self._fill(word, len(word) - 1)
            n = self._levelled[word] = self._step(word, len(word), self.END)[1]
        return n

    def count_word(self, word: str) -> int:
        n = self._word.get(word)
        if n is None:
            levelled = "".join(map(self.alphabet.__getitem__, word.encode()))
            if len(word) > LONG:
                return self._count_levelled(levelled)
            if len(self._word) > MEMO:
                self._word.clear()
            n = self._word[word] = self._count_levelled(levelled)
        return n

    def table(self, text: str, budget: int | None = None) -> PrefixTable:
        return PrefixTable(self, text, budget)

    def count(self, text: str) -> int:
        return sum(n for _, _, n in self._segments(text))

    def _segments(self, text: str):
        """(kind, text, count) of the stretches between special strings and of those strings."""
        at = 0
        for m in self.special_re.finditer(text) if self.special_re and "<" in text else ():
            if m.start() > at:
                yield "text", text[at : m.start()], sum(self.piece_counts(text[at : m.start()]))
            yield "special", m[0], 1
            at = m.end()
        if at < len(text):
            yield "text", text[at:], sum(self.piece_counts(text[at:]))

    def piece_counts(self, text: str) -> list[int]:
        if _PLAIN.fullmatch(text):
            known, count = self._word, self.count_word
            return [known.get(w) or count(w) for w in _PIECE.findall(text.lower())]
        return [self._count_levelled(w) for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))]


    def words(self, text: str):
        """(start, end, tokens) of the words of a text in order, in characters of the source, for any script.

        Words whose source overlaps (one character may become several words) are one entry.
        """
        for at, stretch in _stretches(text):
            for kind, part, n in self._segments(stretch):
                if kind == "special":
                    yield at, at + len(part), n
                elif _PLAIN.fullmatch(part):
                    for m in _PIECE.finditer(part.lower()):
                        yield at + m.start(), at + m.end(), self.count_word(m[0])
                else:
                    yield from self._located(part, at)
                at += len(part)

    def _located(self, part: str, at: int):
        from tokenizers import PreTokenizedString

        cut = PreTokenizedString(part)
        cut.normalize(self.library.normalizer.normalize)
        self.library.pre_tokenizer.pre_tokenize(cut)
        found: list[list[int]] = []
        for word, (start, end), _ in cut.get_splits(offset_referential="original", offset_type="char"):
            while end < len(part) and unicodedata.combining(part[end]):  # marks that were composed
                end += 1
            n = self._count_levelled(word)
            if found and start < found[-1][1]:
                found[-1][1] = max(found[-1][1], end)
                found[-1][2] += n
            else:
                found.append([start, end, n])
        for start, end, n in found:
            yield at + start, at + end, n


def _stretches(text: str):
    """(place, stretch) of a long text, cut behind blanks, where no word or special string spans the cut."""
    at = 0
    while at < len(text):
        cut = text.find(" ", at + STRETCH) + 1 or len(text)
        while cut < len(text) and text[cut].isspace() | bool(unicodedata.combining(text[cut])):
            cut += 1
        yield at, text[at:cut]
        at = cut


class PrefixTable:
    """Token counts of every prefix of one text: stored at the word ends, one DP step within a word.

    With a ``budget``, the table ends behind the first word that goes beyond it.
    """

    def __init__(self, bpe: PrefixBpe, text: str, budget: int | None = None) -> None:
        self.bpe, self.text = bpe, text
        self.starts: list[int] = []
        self.ends: list[int] = []
        self.sums = [0]
        for start, end, n in bpe.words(text):
            self.starts.append(start)
            self.ends.append(end)
            self.sums.append(self.sums[-1] + n)
            if budget is not None and self.sums[-1] > budget:
                break

    @property
    def total(self) -> int:
        return self.sums[-1]

    def count_at(self, p: int) -> int:
        """Tokens of text[:p], as the library counts that prefix."""
        k = bisect.bisect_right(self.ends, p)
        if k == len(self.ends) or self.starts[k] >= p:
            return self.sums[k]
        while k and self.ends[k - 1] == self.starts[k] and self.text[self.starts[k]] == "<":
            k -= 1  # a special string cut in two joins what stands before it
        return self.sums[k] + self.bpe.count(self.text[self.starts[k] : p])

    def fit(self, budget: int) -> int:
        """The longest stored prefix (characters, at a word end) of at most ``budget`` tokens."""
        k = bisect.bisect_right(self.sums, budget) - 1
        return len(self.text) if k == len(self.ends) else self.ends[k - 1] if k else 0


@functools.lru_cache(maxsize=2)
def _tables(path: str | None) -> PrefixBpe:
    """A worker's vocabulary: its memo of words serves all tasks that the worker runs."""
    return PrefixBpe(path or default_path())


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit, fit_chars (the prefix within ``limit`` tokens)."""

    def kernel(part: pa.RecordBatch) -> dict:
        bpe = _tables(path)
        n_bytes, n_tokens, fits = [], [], []
        for text in part.column(1).to_pylist():
            text = text or ""
            n = bpe.count(text)
            n_bytes.append(len(text.encode()))
            n_tokens.append(n)
            fits.append(len(text) if n <= limit else bpe.table(text, limit).fit(limit))
        return {
            id_col: part.column(0),
            "n_bytes": pa.array(n_bytes, pa.int64()),
            "n_tokens": pa.array(n_tokens, pa.int64()),
            "over_limit": pa.array([n > limit for n in n_tokens], pa.bool_()),
            "fit_chars": pa.array(fits, pa.int64()),
        }

    id_type = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(docs[id_col], docs[text_col].alias("text"))
    return map_text(chosen, kernel, f"{id_col} {id_type}, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
