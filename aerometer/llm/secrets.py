"""Secret scans by grammar inference.

Patterns label some credentials. For each kind a prefix tree of labelled values is built over
character classes, and states whose ends and transitions agree statistically are merged into a
probabilistic automaton; one more automaton is learned from runs that no pattern touches. Every
credential-like run of a text is then scored by the likelihood of its format under each kind against
the likelihood under ordinary runs, so values without a tell-tale name are found by their shape.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerometer.llm.common import text_of, written

#: Patterns by kind, the group that is the credential, its least length.
PATTERNS = {
    "assign": (re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]{16,}"), 0, 16),
}
#: The kind of spans that only the automata find.
LEARNED = "format"
#: Runs that are scored.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
#: Distinct values that an automaton is learned from at most, the ones of smallest hash, and their length at most.
SAMPLE, LONGEST = 2000, 128
#: Confidence of the merging test, smoothing of transitions.
ALPHA, SMOOTH = 0.05, 0.1
#: Log odds that a run needs: one ordinary run in a million is a credential.
ODDS = math.log(1e6)
#: Scored formats that a task remembers.
HELD = 100_000

#: Character classes: digits, letters that hexadecimal has, other letters; signs stand for themselves.
_CLASSES = str.maketrans({**dict.fromkeys("0123456789", "0"), **dict.fromkeys("abcdef", "a"), **dict.fromkeys("ghijklmnopqrstuvwxyz", "g"),
                          **dict.fromkeys("ABCDEF", "A"), **dict.fromkeys("GHIJKLMNOPQRSTUVWXYZ", "G")})
ALPHABET = "0agAG+/_.=-"


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, credential) of all pattern matches, by start, then kind as listed."""
    found = []
    for place, (kind, (pattern, group, least)) in enumerate(PATTERNS.items()):
        for m in pattern.finditer(text):
            if len(m[group]) >= least:
                found.append((m.start(), place, m.end(), kind, m[group]))
    return [(start, end, kind, value) for start, _, end, kind, value in sorted(found)]


def candidates(text: str, taken: list[tuple[int, int, str, str]]) -> Iterator[tuple[int, int]]:
    """(start, end) of the runs to score, without those that touch a span of taken (sorted by start)."""
    i, reach = 0, 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while i < len(taken) and taken[i][0] < end:
            reach = max(reach, taken[i][1])
            i += 1
        if reach <= start:
            yield start, end


def skeleton(run: str) -> str:
    return run.translate(_CLASSES)


@dataclass
class Automaton:
    """A probabilistic automaton; moves[q][symbol] is [next state, count], state 0 the first."""

    visits: list[int]
    ends: list[int]
    moves: list[dict[str, list[int]]]

    def log_likelihood(self, word: str) -> float:
        """Of a word of symbols, its end included; an unseen move goes back to the first state."""
        total, q, kinds = 0.0, 0, len(ALPHABET) + 1
        for symbol in word:
            move = self.moves[q].get(symbol)
            total += math.log(((move[1] if move else 0) + SMOOTH) / (self.visits[q] + SMOOTH * kinds))
            q = move[0] if move else 0
        return total + math.log((self.ends[q] + SMOOTH) / (self.visits[q] + SMOOTH * kinds))


def prefix_tree(words: Iterable[str]) -> Automaton:
    tree = Automaton([0], [0], [{}])
    for word in words:
        q = 0
        tree.visits[0] += 1
        for symbol in word:
            move = tree.moves[q].setdefault(symbol, [len(tree.visits), 0])
            if move[0] == len(tree.visits):
                tree.visits.append(0)
                tree.ends.append(0)
                tree.moves.append({})
            move[1] += 1
            q = move[0]
            tree.visits[q] += 1
        tree.ends[q] += 1
    return tree


def agree(x1: int, n1: int, x2: int, n2: int) -> bool:
    """Hoeffding's test that two frequencies may have one probability."""
    return abs(x1 / n1 - x2 / n2) <= math.sqrt(math.log(2 / ALPHA) / 2) * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))


def compatible(a: Automaton, p: int, q: int) -> bool:
    """Whether states p and q agree in their ends, their moves and, in turn, the states these reach."""
    waiting = [(p, q)]
    while waiting:
        p, q = waiting.pop()
        if not agree(a.ends[p], a.visits[p], a.ends[q], a.visits[q]):
            return False
        for symbol in a.moves[p].keys() | a.moves[q].keys():
            left, right = a.moves[p].get(symbol), a.moves[q].get(symbol)
            if not agree(left[1] if left else 0, a.visits[p], right[1] if right else 0, a.visits[q]):
                return False
            if left and right:
                waiting.append((left[0], right[0]))
    return True


def fold(a: Automaton, p: int, q: int) -> None:
    """Adds the subtree of q to p, move by move."""
    waiting = [(p, q)]
    while waiting:
        p, q = waiting.pop()
        a.visits[p] += a.visits[q]
        a.ends[p] += a.ends[q]
        for symbol, (to, n) in a.moves[q].items():
            own = a.moves[p].get(symbol)
            if own:
                own[1] += n
                waiting.append((own[0], to))
            else:
                a.moves[p][symbol] = [to, n]


def infer(words: Iterable[str]) -> Automaton:
    """The automaton of words of symbols: states of their prefix tree, breadth first, join the first compatible
    state that is settled, or are settled themselves."""
    a = prefix_tree(sorted(words))
    settled, waiting = [0], deque((0, s) for s in sorted(a.moves[0]))
    while waiting:
        parent, symbol = waiting.popleft()
        q = a.moves[parent][symbol][0]
        if q in settled:
            continue
        twin = next((p for p in settled if compatible(a, p, q)), None)
        if twin is None:
            settled.append(q)
            waiting.extend((q, s) for s in sorted(a.moves[q]))
            continue
        before = {p: set(a.moves[p]) for p in settled}
        a.moves[parent][symbol][0] = twin
        fold(a, twin, q)
        waiting.extend((p, s) for p in settled for s in sorted(set(a.moves[p]) - before[p]))
    place = {q: i for i, q in enumerate(settled)}
    return Automaton([a.visits[q] for q in settled], [a.ends[q] for q in settled],
                     [{s: [place[to], n] for s, (to, n) in a.moves[q].items()} for q in settled])


def samples(docs: DataFrame, size: int = SAMPLE) -> dict[str, list[str]]:
    """Formats of at most size distinct values of each kind, LEARNED standing for ordinary runs: those of
    smallest hash over all of docs, of LONGEST characters at most. Tasks hand on no more than that either."""
    def gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[str, dict[str, int]] = {}

        def add(kind: str, value: str) -> None:
            of = best.setdefault(kind, {})
            if value not in of and len(value) <= LONGEST:
                of[value] = zlib.crc32(value.encode())
                if len(of) > 2 * size:
                    best[kind] = dict(heapq.nsmallest(size, of.items(), key=lambda x: (x[1], x[0])))

        for pdf in batches:
            for text in pdf["text"]:
                spans = base_spans(text)
                for _, _, kind, value in spans:
                    add(kind, value)
                for start, end in candidates(text, spans):
                    add(LEARNED, text[start:end])
        rows = [(k, h, v) for k, of in best.items() for v, h in heapq.nsmallest(size, of.items(), key=lambda x: (x[1], x[0]))]
        yield pd.DataFrame(rows, columns=["kind", "hash", "value"], dtype=object)

    found = written(docs.select(text_of().alias("text")).mapInPandas(gathered, "kind string, hash long, value string"), "secret-samples").distinct()
    out = {}
    for kind in (*PATTERNS, LEARNED):
        rows = found.where(F.col("kind") == kind).orderBy("hash", "value").limit(size).collect()
        out[kind] = [skeleton(r.value) for r in rows]
    return out


@dataclass
class SecretModel:
    """Automata of the kinds and of ordinary runs."""

    kinds: dict[str, Automaton]
    ordinary: Automaton

    def log_odds(self, form: str) -> float:
        """How much likelier a format is under the best kind than among ordinary runs."""
        if not self.kinds:
            return -math.inf
        return max(a.log_likelihood(form) for a in self.kinds.values()) - self.ordinary.log_likelihood(form)


def learned(by_kind: dict[str, list[str]]) -> SecretModel:
    """Automata of the formats of each kind and of ordinary runs. Among these are unlabelled credentials, so those
    likelier under a kind leave the ordinary ones, round by round, until none does."""
    kinds = {k: infer(by_kind[k]) for k in PATTERNS if by_kind.get(k)}
    plain = by_kind.get(LEARNED, [])
    while True:
        model = SecretModel(kinds, infer(plain))
        left = [w for w in plain if model.log_odds(w) <= 0]
        if len(left) == len(plain):
            return model
        plain = left


def fit(docs: DataFrame, size: int = SAMPLE) -> SecretModel:
    """Automata from the credentials that the patterns label in docs (text); a kind without any has none."""
    return learned(samples(docs, size))


def scan(docs: DataFrame, model: SecretModel | None = None, odds: float = ODDS) -> DataFrame:
    """doc_id and spans of every row of docs (doc_id, text): structs (start, end, kind, score), in order.

    start and end are code points, the end exclusive. Kinds are those of the patterns (score null) and
    LEARNED for runs that touch no pattern's match and whose format has log odds of at least odds. A null
    text is empty and has no spans, as has an empty one; a null doc_id stays null; repeated rows are
    scanned each; texts of any length are read whole; an empty table gives no rows.
    """
    model = model or fit(docs)

    def scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, float] = {}
        for pdf in batches:
            out = []
            for text in pdf["text"]:
                base = base_spans(text)
                spans = [(start, end, kind, None) for start, end, kind, _ in base]
                for start, end in candidates(text, base):
                    form = skeleton(text[start:end])
                    score = known.get(form)
                    if score is None:
                        if len(known) > HELD:
                            known.clear()
                        score = known[form] = model.log_odds(form)
                    if score >= odds:
                        spans.append((start, end, LEARNED, score))
                spans.sort(key=lambda s: s[0])
                out.append([{"start": s[0], "end": s[1], "kind": s[2], "score": s[3]} for s in spans])
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "spans": out})

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_of().alias("text"))
    return rows.mapInPandas(scanned, "doc_id string, spans array<struct<start:long,end:long,kind:string,score:double>>").withColumn(
        "doc_id", F.col("doc_id").cast("long"))


def digests(scans: DataFrame) -> DataFrame:
    """doc_id, the counts of the patterns' spans, their digest, and all spans as text."""
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return scans.select(
        "doc_id", *(of(k).alias(f"n_{k}") for k in PATTERNS),
        F.sha2(written(F.filter("spans", lambda s: s["kind"] != LEARNED)).cast("binary"), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"))
