"""Licence notices found with a generalised suffix automaton of licence words.

Every file is streamed once through the automaton, which gives the matching statistics: for each
word the longest run ending there that occurs in some template. Whole phrases are read from the
suffix links; long maximal matches are chained, per template, into covered spans.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame

from replyscope.llm import fixed_values as fixed
from replyscope.llm.rows import map_batches, text_bytes

FIELDS = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
    "score double, spans array<struct<label:string,first_word:bigint,last_word:bigint,share:double>>"
)
SPANS = pa.list_(
    pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("share", pa.float64())])
)


def words_of(text: str | bytes | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased, as UTF-8 bytes."""
    raw = text.encode() if isinstance(text, str) else text or b""
    return re.findall(fixed.WORD_BYTES, raw.lower())


class LicenceAutomaton:
    """Generalised suffix automaton over the words of phrases and templates.

    Its size is linear in the number of template words, which the caller supplies.
    """

    def __init__(self, phrases, templates, min_match: int, min_cover: float, max_gap: int):
        self.phrases = [(label, len(words_of(text))) for label, text in phrases]
        self.templates = [(label, len(words_of(text))) for label, text in templates]
        self.min_match, self.min_cover, self.max_gap = min_match, min_cover, max_gap
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set[tuple[int, int]]] = [set()]
        phrase_state = []
        for number, (_, text) in enumerate([*phrases, *templates]):
            last = 0
            for at, word in enumerate(words_of(text)):
                last = self._extend(last, word)
                while len(ends) < len(self.link):
                    ends.append(set())
                if number >= len(phrases):
                    ends[last].add((number - len(phrases), at + 1))
            if number < len(phrases):
                phrase_state.append(text)
        # Ends of a state are the ends of all states below it in the tree of suffix links
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            ends[self.link[state]] |= ends[state]
        self.ends = [sorted(found) for found in ends]
        whole = {}
        for number, text in enumerate(phrase_state):
            state = 0
            for word in words_of(text):
                state = self.next[state][word]
            whole.setdefault(state, []).append(number)
        self.whole: list[tuple[int, ...]] = [()] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            self.whole[state] = (*self.whole[self.link[state]], *whole.get(state, ()))

    def _extend(self, last: int, word: bytes) -> int:
        """Add a word after the state ``last``; other templates may have made that step before."""
        if word in self.next[last]:
            known = self.next[last][word]
            return known if self.length[known] == self.length[last] + 1 else self._clone(last, word, known)
        state = self._new(self.length[last] + 1, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = state
            last = self.link[last]
        if last < 0:
            self.link[state] = 0
        else:
            known = self.next[last][word]
            exact = self.length[known] == self.length[last] + 1
            self.link[state] = known if exact else self._clone(last, word, known)
        return state

    def _new(self, length: int, following: dict[bytes, int]) -> int:
        self.next.append(following)
        self.link.append(0)
        self.length.append(length)
        return len(self.link) - 1

    def _clone(self, last: int, word: bytes, known: int) -> int:
        copy = self._new(self.length[last] + 1, dict(self.next[known]))
        self.link[copy], self.link[known] = self.link[known], copy
        while last >= 0 and self.next[last].get(word) == known:
            self.next[last][word] = copy
            last = self.link[last]
        return copy

    def stream(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]]]:
        """(phrase, start) of every whole phrase, and (end, state, length) of every long maximal match."""
        following, link, lengths, whole = self.next, self.link, self.length, self.whole
        known, least = following[0], self.min_match
        phrases, matches = [], []
        state = length = 0
        for at, word in enumerate(words):
            if word in following[state]:
                state = following[state][word]
                length += 1
            elif word not in known:
                if length >= least:
                    matches.append((at, state, length))
                state = length = 0
                continue
            else:
                if length >= least:
                    matches.append((at, state, length))
                while word not in following[state]:
                    state = link[state]
                length = lengths[state] + 1
                state = following[state][word]
            if whole[state]:
                for number in whole[state]:
                    size = self.phrases[number][1]
                    if size <= length:
                        phrases.append((number, at + 1 - size))
        if length >= least:
            matches.append((len(words), state, length))
        return phrases, matches

    def chain(self, matches: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float]]:
        """(label, first word, last word, covered share) of templates that chained matches cover well enough.

        A chain goes forward in the text and in the template, with at most ``max_gap`` foreign words
        between two matches, so only chains that ended a moment ago are looked at.
        """
        open_chains: dict[int, list[list[int]]] = {}
        done: dict[int, list[list[int]]] = {}
        for end, state, length in matches:
            start = end - length
            for template, template_end in self.ends[state]:
                template_start = template_end - length
                chains = [c for c in open_chains.get(template, []) if start - c[1] <= self.max_gap]
                best = [start, end, template_end, length]
                for first, last, reached, covered in chains:
                    fresh = length - max(0, last - start, reached - template_start)
                    if fresh > 0 and covered + fresh > best[3]:
                        best = [first, end, template_end, covered + fresh]
                chains.append(best)
                open_chains[template] = chains
                if best[3] >= self.min_cover * self.templates[template][1]:
                    done.setdefault(template, []).append(best)
        spans = []
        for template, chains in done.items():
            label, size = self.templates[template]
            taken: list[tuple[int, int]] = []
            for first, last, _, covered in sorted(chains, key=lambda c: (-c[3], c[1] - c[0], c[0])):
                at = bisect_left(taken, (first, last))
                if (at == 0 or taken[at - 1][1] <= first) and (at == len(taken) or taken[at][0] >= last):
                    taken.insert(at, (first, last))
                    spans.append((label, first, last - 1, min(1.0, covered / size)))
        return sorted(spans, key=lambda s: (s[1], s[2], s[0]))

    def scan(self, words: list[bytes]) -> tuple:
        phrases, matches = self.stream(words)
        spans = self.chain(matches)
        starts = [start for _, start in phrases]
        base = {self.phrases[number][0] for number, _ in phrases}
        labels = base | {span[0] for span in spans}
        share = 1.0 if phrases else max((span[3] for span in spans), default=0.0)
        return (
            len(words),
            len(phrases),
            min(starts, default=None),
            max(starts, default=None),
            ",".join(sorted(base)),
            ",".join(sorted(labels)),
            share,
            [dict(zip(("label", "first_word", "last_word", "share"), span, strict=True)) for span in spans],
        )


def scan_licences(
    docs: DataFrame,
    phrases: Iterable[tuple[str, str]] = tuple(fixed.BASE_PHRASES),
    templates: Iterable[tuple[str, str]] = tuple(fixed.LICENCE_TEMPLATES),
    min_match: int = 3,
    min_cover: float = 0.75,
    max_gap: int = 6,
    keep: Iterable[str] | None = None,
) -> DataFrame:
    """Licence labels, places and covered template spans of every text.

    ``phrases`` count only where all their words stand consecutively, at every place; ``templates``
    count where chained matches of at least ``min_match`` words cover ``min_cover`` of their words.
    A null or empty text has no words, no labels and score 0. Every row is judged alone, so
    repeated rows give repeated results, an empty table an empty one, and other columns are kept
    unless they have the name of a result. No data is shuffled; the automaton is as large as the
    templates that the caller gives.
    """
    phrases, templates = list(phrases), list(templates)

    def work():
        automaton = LicenceAutomaton(phrases, templates, min_match, min_cover, max_gap)

        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            rows = [automaton.scan(words_of(text.as_py())) for text in text_bytes(batch)]
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), SPANS]
            return [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)]

        return step

    return map_batches(docs, ["text"], docs.columns if keep is None else keep, FIELDS, work)
