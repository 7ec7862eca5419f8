"""Personal data: fixed patterns, and a skip-chain conditional random field that adds to them.

The patterns give the base spans, which always stay. A document's tokens with a digit
or an ``@`` then form a graph: neighbours are chained, and distant tokens that repeat
or resemble each other (same text, same last digits, also those of a number written in
several groups) share an edge from each to the occurrence before it and to the first one, so
any two are a few links apart. Loopy message passing over that graph, with the base spans
observed, goes on in each document until its messages stand still and gives
every token its label probabilities; tokens that are surely of a kind that the document has a
base span of, and in no base span, become further spans of that kind. Documents share a graph up to ``GRAPH_TOKENS`` tokens, so
messages are whole numpy arrays of a bounded size, and a token has at most two edges back for each of its keys.
A document of more tokens is taken in windows of so many: links go within a window, and a token that
resembles a base span elsewhere in the document gets that span's message all the same.

The field's weights are fitted here by pseudo-likelihood on a bounded sample, labelled
by the base spans: at most ``TRAIN_TOKENS`` tokens of least hash, out of the about
``TRAIN_DOCS`` documents of least id hash. Every token is learned from twice: as it is, and as a repeat
whose form is hidden behind that of a token without kind, so that only its links tell what it is. That
teaches the field to call repeats that no pattern matches.

Messages that swing for ever end after ``ROUNDS`` rounds; ``at_rest`` tells for each row whether they stood still.

Defined cases: null counts as empty and has no spans; without a token to train on,
the field adds nothing; spans of different kinds may overlap, those of one kind don't.
Repeated rows each get a row; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import byte_class, map_batches, utf8

# Fixed values of the base kinds, in their listed order, and of their patterns.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

TRAIN_DOCS = 100_000
TRAIN_TOKENS = 20_000
FEATURES = 1 << 12
# Messages are at rest when none changes by more than STILL; ROUNDS bounds those that swing for ever.
STILL = 1e-3
ROUNDS = 200
TAIL = 7  # digits at the end by which numbers resemble each other
SURE = 0.9
GRAPH_TOKENS = 20_000

_MARKS = byte_class(b"0123456789@")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"\S+")
_LETTER = re.compile(r"[^\W\d_]")
_EDGE_MARKS = ".,;:!?\"'()[]{}<>|"

Span = tuple[int, int, int]  # start, end, number of the kind


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    # Every match has one @, and its local part can't pass the @ or the match before.
    floor, at = 0, text.find("@")
    while at >= 0:
        end = at + 1
        start = floor + len(text[floor:at].rstrip(_LOCAL))
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield start, end, 0
        floor, at = end, text.find("@", end)


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns, by start, then kind."""
    found = list(_emails(text))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), 2))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            found.append((m.start(), m.end(), 3))
    return sorted(found, key=lambda s: (s[0], s[2]))


def _shape(token: str) -> str:
    runs = re.sub(r"[^\W\d_]+", "a", token)
    return re.sub(r"9{5,}", "9+", re.sub(r"[0-9]", "9", runs))[:24]


def _features(token: str, before: str, after: str) -> list[int]:
    digits = _digits(token)
    named = ["bias", f"shape {_shape(token)}", f"core {_shape(token.strip(_EDGE_MARKS))}", f"digits {min(len(digits), 20)}",
             f"before {before.lower()[:12]}", f"after shape {_shape(after)}", f"before shape {_shape(before)}"]
    if "@" in token:
        named.append(f"at, dot after: {'.' in token[token.find('@'):]}")
    if 14 <= len(digits) <= 19:
        named.append(f"luhn {luhn(digits)}")
    return [zlib.crc32(n.encode()) % FEATURES for n in named]


def _likeness(token: str) -> list[str]:
    """Tokens with a key in common are linked: same core, or same last digits."""
    core, digits = token.strip(_EDGE_MARKS).lower(), _digits(token)
    return ([f"t{core}"] if len(core) >= 6 else []) + ([f"d{digits[-TAIL:]}"] if len(digits) >= TAIL else [])


def _group_keys(groups: list[str]) -> list[list[str]]:
    """Further keys of neighbouring groups of digits, as of '802 555 9869': the last digits of the groups up to each,
    for that group and, with the digits that follow, for those before it that hold the rest of them."""
    keys: list[list[str]] = [[] for _ in groups]
    for k, own in enumerate(groups):
        if len(own) >= TAIL:
            continue
        first, joined = k, own
        while first and len(joined) < TAIL:
            first -= 1
            joined = groups[first] + joined
        if len(joined) < TAIL:
            continue
        tail, after = f"d{joined[-TAIL:]}", 0
        for m in range(k, first - 1, -1):
            keys[m].append(f"{tail}<{after}" if after else tail)
            after += len(groups[m])
    return keys


Token = tuple[int, int, int, str, str]  # number, start, end, token before, token after


def _tokens(text: str) -> Iterator[Token]:
    """The tokens with a digit or an @, with their neighbours."""
    number, before, found = -1, "", None
    for m in _TOKEN.finditer(text):
        token = m[0]
        if found is not None:
            yield (*found, token)
            found = None
        number += 1
        if "@" in token or _DIGIT.search(token):
            found = number, m.start(), m.end(), before
        before = token
    if found is not None:
        yield (*found, "")


class _Document:
    """One document's tokens on their way into graphs: their labels, and the keys by which they are linked."""

    def __init__(self, text: str, spans: list[Span]):
        self.text, self.spans, self.next_span, self.last = text, spans, 0, -2
        self.keys: list[list[str]] = []
        self.run: list[str] = []  # the groups of digits that the last tokens are

    def label(self, a: int, b: int) -> int:
        """The kind (from 1) of the first base span that a token is in; 0 for none. Tokens must follow one another."""
        while self.next_span < len(self.spans) and self.spans[self.next_span][1] <= a:
            self.next_span += 1
        for start, end, kind in self.spans[self.next_span:]:
            if start >= b:  # spans go by their start
                return 0
            if end > a:
                return kind + 1
        return 0

    def link(self, number: int, token: str) -> bool:
        """Take in the token's keys; whether it follows the one before it."""
        follows = self.last == number - 1
        grouped = not _LETTER.search(token) and "@" not in token
        if not follows or not grouped:
            self.close()
        self.last = number
        self.keys.append(_likeness(token))
        if grouped:
            self.run.append(_digits(token))
        return follows

    def close(self) -> None:
        for own, more in zip(self.keys[len(self.keys) - len(self.run):], _group_keys(self.run)):
            own += more
        self.run.clear()

    def taken(self) -> list[list[str]]:
        """The keys of the tokens since the last call."""
        self.close()
        keys, self.keys, self.last = self.keys, [], -2
        return keys


def _evidence(text: str, spans: list[Span]) -> dict[str, int]:
    """The label of each key that a token of a base span has, the first one's."""
    document, found, labels = _Document(text, spans), {}, []

    def note() -> None:
        for keys, label in zip(document.taken(), labels):
            for key in keys if label else ():
                found.setdefault(key, label)
        labels.clear()

    for number, a, b, _, _ in _tokens(text):
        labels.append(document.label(a, b))
        document.link(number, text[a:b])
        if len(labels) == GRAPH_TOKENS:
            note()
    note()
    return found


@dataclass
class Graph:
    """The tokens of some documents; label 0 is none, k + 1 is kind k."""

    owner: list[int] = field(default_factory=list)
    bounds: list[tuple[int, int]] = field(default_factory=list)
    features: list[list[int]] = field(default_factory=list)
    label: list[int] = field(default_factory=list)
    chain: list[tuple[int, int]] = field(default_factory=list)
    skip: list[tuple[int, int]] = field(default_factory=list)
    # Tokens that resemble a base span outside the graph, and its label.
    hints: list[tuple[int, int]] = field(default_factory=list)

    def add(self, owner: int, text: str, spans: list[Span]) -> None:
        """A whole document."""
        document = _Document(text, spans)
        first = len(self.owner)
        for token in _tokens(text):
            self._take(owner, document, token)
        self._link(first, document, {})

    def _take(self, owner: int, document: _Document, found: Token) -> None:
        number, a, b, before, after = found
        node, token = len(self.owner), document.text[a:b]
        self.owner.append(owner)
        self.bounds.append((a, b))
        self.label.append(document.label(a, b))
        self.features.append(_features(token, before, after))
        if document.link(number, token):
            self.chain.append((node - 1, node))

    def cut(self, first: int) -> Graph:
        """Take the nodes from ``first`` on, which are not linked yet, into a graph of their own."""
        kept = Graph(self.owner[first:], self.bounds[first:], self.features[first:], self.label[first:],
                     [(a - first, b - first) for a, b in self.chain if a >= first])
        for column in (self.owner, self.bounds, self.features, self.label):
            del column[first:]
        self.chain = [(a, b) for a, b in self.chain if b < first]
        return kept

    def _link(self, first_node: int, document: _Document, evidence: dict[str, int]) -> None:
        first: dict[str, int] = {}
        latest: dict[str, int] = {}
        for node, own in enumerate(document.taken(), first_node):
            links = {seen[key] for key in own for seen in (first, latest) if key in seen}
            self.skip.extend((other, node) for other in sorted(links))
            if evidence and not self.label[node]:
                self.hints.extend((node, label) for label in {evidence[key] for key in own if key in evidence and key not in first})
            for key in own:
                first.setdefault(key, node)
                latest[key] = node


def graphs(documents: Iterator[tuple[int, str, list[Span]]], most: int | None = None) -> Iterator[Graph]:
    """Graphs of at most ``most`` tokens, whole documents together; one with more tokens in windows of its own."""
    most = most or GRAPH_TOKENS
    graph = Graph()
    for owner, text, spans in documents:
        document, first = _Document(text, spans), len(graph.owner)
        evidence: dict[str, int] | None = None
        for token in _tokens(text):
            if len(graph.owner) == most:
                if first:  # what came before goes first; the document begins anew in the next graph
                    kept = graph.cut(first)
                    yield graph
                    graph, first = kept, 0
                else:
                    if evidence is None:
                        evidence = _evidence(text, spans)
                    graph._link(0, document, evidence)
                    yield graph
                    graph = Graph()
            graph._take(owner, document, token)
        graph._link(first, document, evidence or {})
    if graph.owner:
        yield graph


LABELS = len(KINDS) + 1


@dataclass(frozen=True)
class Field:
    """Weights of features, of chained labels (from, to) and of linked labels."""

    node: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def _normal(scores: np.ndarray) -> np.ndarray:
    p = np.exp(scores - scores.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def fit(features: list[list[int]], label: np.ndarray, before: np.ndarray, after: np.ndarray, linked: np.ndarray,
        ridge: float = 0.02, steps: int = 150, rate: float = 0.3) -> Field:
    """Pseudo-likelihood by Adagrad: each token given its neighbours' labels (-1: none; ``linked`` counts them)."""
    n = len(label)
    row = np.repeat(np.arange(n), [len(f) for f in features])
    column = np.fromiter((c for f in features for c in f), np.int64, len(row))
    one = np.eye(LABELS + 1)[:, :LABELS]  # the line of -1 is zero
    prev, follow, truth = one[before], one[after], one[label]
    weights = [np.zeros((FEATURES, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS))]
    seen = [np.full(w.shape, 1e-6) for w in weights]
    for _ in range(steps if n else 0):
        node, chain, skip = weights
        score = prev @ chain + follow @ chain.T + linked @ skip
        np.add.at(score, row, node[column])
        off = _normal(score) - truth
        slopes = [np.zeros_like(node), prev.T @ off + off.T @ follow, linked.T @ off]
        np.add.at(slopes[0], column, off[row])
        slopes[2] = slopes[2] + slopes[2].T  # an edge has no direction
        for w, g, s in zip(weights, slopes, seen):
            g = g / n + ridge / n * w
            s += g * g
            w -= rate * g / np.sqrt(s)
    return Field(*weights)


def marginals(graph: Graph, model: Field, rounds: int = ROUNDS, damping: float = 0.5) -> np.ndarray:
    """Label probabilities of every token by loopy message passing; tokens of base spans are observed."""
    return _passed(graph, model, rounds, damping)[0]


def _passed(graph: Graph, model: Field, rounds: int = ROUNDS, damping: float = 0.5) -> tuple[np.ndarray, set[int]]:
    """The same, and the documents whose messages did not come to rest."""
    n = len(graph.owner)
    unary = np.zeros((n, LABELS))
    row = np.repeat(np.arange(n), [len(f) for f in graph.features])
    np.add.at(unary, row, model.node[np.fromiter((c for f in graph.features for c in f), np.int64, len(row))])
    if graph.hints:
        node, told = np.array(graph.hints, np.int64).T
        np.add.at(unary, node, model.skip[told])
    label = np.array(graph.label, np.int64)
    unary[label > 0] = -20.0
    unary[label > 0, label[label > 0]] = 20.0
    chain, skip = (np.array(e, np.int64).reshape(-1, 2) for e in (graph.chain, graph.skip))
    source = np.concatenate([chain[:, 0], skip[:, 0], chain[:, 1], skip[:, 1]])
    target = np.concatenate([chain[:, 1], skip[:, 1], chain[:, 0], skip[:, 0]])
    half = len(source) // 2
    # One matrix for each kind of edge and direction.
    tables = (model.chain, model.skip, model.chain.T, model.skip.T)
    kind = np.repeat(np.arange(4, dtype=np.int8), [len(chain), len(skip)] * 2)
    back = np.concatenate([np.arange(half, 2 * half), np.arange(half)])
    message = np.zeros((2 * half, LABELS))
    owner = np.array(graph.owner, np.int64)[target]
    moving = np.arange(2 * half)  # the edges of documents that are not at rest
    for _ in range(rounds):
        if not len(moving):
            break
        total = unary.copy()
        np.add.at(total, target[moving], message[moving])
        sent = total[source[moving]] - message[back[moving]]
        fresh, kinds = np.empty_like(sent), kind[moving]
        for k, table in enumerate(tables):
            mine = np.flatnonzero(kinds == k)
            scores = sent[mine][:, :, None] + table
            top = scores.max(axis=1)
            fresh[mine] = top + np.log(np.exp(scores - top[:, None, :]).sum(axis=1))
        fresh -= fresh.max(axis=1, keepdims=True)
        fresh = damping * message[moving] + (1 - damping) * fresh
        change = np.zeros(owner.max() + 1)
        np.maximum.at(change, owner[moving], np.abs(fresh - message[moving]).max(axis=1))
        message[moving] = fresh
        moving = moving[change[owner[moving]] > STILL]
    np.add.at(unary, target, message)
    return (_normal(unary) if n else unary), set(owner[moving].tolist())


def added_spans(graph: Graph, sure: np.ndarray, texts: dict[int, str]) -> dict[int, list[Span]]:
    """Tokens outside base spans with a kind's probability of ``SURE``; chained ones of a kind are one span."""
    best = sure.argmax(axis=1)
    taken = (best > 0) & (sure.max(axis=1) >= SURE) & (np.array(graph.label) == 0)
    follows = {b for a, b in graph.chain}
    found: dict[int, list[Span]] = {}
    last = -2
    for node in np.flatnonzero(taken).tolist():
        owner, (a, b), kind = graph.owner[node], graph.bounds[node], int(best[node]) - 1
        token = texts[owner][a:b]
        start = a + len(token) - len(token.lstrip(_EDGE_MARKS))
        end = b - len(token) + len(token.rstrip(_EDGE_MARKS))
        own = found.setdefault(owner, [])
        if last == node - 1 and node in follows and own and own[-1][2] == kind:
            own[-1] = (own[-1][0], end, kind)
        else:
            own.append((start, end, kind))
        last = node
    return found


def _marked(column: pa.Array) -> Iterator[tuple[int, str]]:
    """Rows that have a digit or an @."""
    raw, offsets = utf8(column)
    marked = np.concatenate([[0], np.cumsum(_MARKS[raw])])
    data = raw.tobytes()
    for k in np.flatnonzero(marked[offsets[1:]] > marked[offsets[:-1]]).tolist():
        yield k, data[offsets[k]:offsets[k + 1]].decode()


def find(column: pa.Array, model: Field) -> dict[int, tuple[list[Span], list[Span], bool]]:
    """(base, all, at rest) of the rows that have a digit or an @."""
    base: dict[int, list[Span]] = {}
    texts: dict[int, str] = {}
    more: dict[int, list[Span]] = {}
    moving: set[int] = set()

    def documents() -> Iterator[tuple[int, str, list[Span]]]:
        for k, text in _marked(column):
            base[k], texts[k] = base_spans(text), text
            yield k, text, base[k]

    for graph in graphs(documents()):
        sure, unsettled = _passed(graph, model)
        moving |= unsettled
        for k, own in added_spans(graph, sure, texts).items():
            more.setdefault(k, []).extend(own)
        for k in [k for k in texts if k < graph.owner[-1]]:
            del texts[k]
    found = {}
    for k, own in base.items():
        kinds = {kind for _, _, kind in own}  # a document's own spans bear out what is added
        borne = [s for s in more.get(k, []) if s[2] in kinds]
        found[k] = own, sorted(own + _clear(borne, own), key=lambda s: (s[0], s[2])) if borne else own, k not in moving
    return found


def _clear(spans: list[Span], base: list[Span]) -> list[Span]:
    """Those of ``spans`` (by start) that no base span meets."""
    if not base:
        return spans
    starts = np.array([a for a, _, _ in base])
    reach = np.maximum.accumulate([b for _, b, _ in base])  # the furthest end so far
    kept = []
    for span in spans:
        before = int(np.searchsorted(starts, span[1])) - 1  # the last base span that starts before this one ends
        if before < 0 or reach[before] <= span[0]:
            kept.append(span)
    return kept


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """Fit the field on a sample of the tokens of ``docs``."""
    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        graph = Graph()
        for k, text in _marked(batch.column(1)):
            graph.add(k, text, base_spans(text))
        n, label = len(graph.owner), np.array(graph.label, np.int64)
        before, after, linked = np.full(n, -1), np.full(n, -1), np.zeros((n, LABELS), np.int64)
        for a, b in graph.chain:
            before[b], after[a] = label[a], label[b]
        for a, b in graph.skip:
            linked[a, label[b]] += 1
            linked[b, label[a]] += 1
        owner = np.array(graph.owner, np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(owner)), pa.array([a for a, _ in graph.bounds], pa.int64()), pa.array(label),
             pa.array(before), pa.array(after), pa.array(linked.tolist(), pa.list_(pa.int64())),
             pa.array(graph.features, pa.list_(pa.int64()))],
            names=["draw", "at", "label", "before", "after", "linked", "features"])

    plain = docs.select(F.xxhash64(F.col(id_col).cast("string"), F.lit("pii")).alias("draw"),
                        F.col(text_col).cast("string").alias("text"))
    share = TRAIN_DOCS / max(1, docs.count())
    if share < 1:
        plain = plain.filter(F.col("draw") <= int(-2 ** 63 + share * 2 ** 64))
    tokens = map_batches(plain, rows, "draw long, at long, label long, before long, after long, linked array<long>, features array<long>")
    sample = (tokens.orderBy(F.xxhash64("draw", "at"), "draw", "at", "label", "before", "after").limit(TRAIN_TOKENS).collect())
    label, before, after = (np.array([r[c] for r in sample], np.int64) for c in ("label", "before", "after"))
    linked = np.array([r.linked for r in sample], float).reshape(-1, LABELS)
    # Once more as repeats in another form: of a base span's token, linked to one of its kind, only the form of a token
    # without kind shows, and of others only the bias.
    bias = _features("0", "", "")[:1]
    plain_forms = [r.features for r in sample if not r.label] or [bias]
    forms = [plain_forms[k % len(plain_forms)] if own else bias for k, own in enumerate(label)]
    hidden = linked.copy()
    hidden[label > 0, label[label > 0]] = np.maximum(hidden[label > 0, label[label > 0]], 1)
    alone = (before == label) | (after == label)  # its neighbours are of the same span, and would be hidden too
    return fit([*[r.features for r in sample], *forms], np.concatenate([label, label]),
               np.concatenate([before, np.where(alone, -1, before)]), np.concatenate([after, np.where(alone, -1, after)]),
               np.concatenate([linked, hidden]))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def spans(docs: DataFrame, model: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base, spans, at_rest) of every row; the counts are of base spans."""
    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, found = batch.num_rows, find(batch.column(1), model)
        counts, base, every, rest = np.zeros((len(KINDS), n), np.int64), [""] * n, [""] * n, [True] * n
        for k, (own, all_own, still) in found.items():
            for _, _, kind in own:
                counts[kind, k] += 1
            base[k], every[k], rest[k] = _joined(own), _joined(all_own), still
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *map(pa.array, counts), pa.array(base, pa.string()), pa.array(every, pa.string()), pa.array(rest, pa.bool_())],
            names=["id", *(f"n_{k}" for k in KINDS), "base", "spans", "at_rest"])

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(plain, rows, "id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string, at_rest boolean")


def masked(text: str, found: list[Span]) -> str:
    """``text`` with each span replaced by its kind; overlapping spans by the first one's."""
    out, at = [], 0
    for a, b, kind in found:
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: Field, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with the spans of the text column masked; ``length_col``, if there, follows a masked text's length."""
    at, schema = docs.columns.index(text_col), docs.schema
    length_at = docs.columns.index(length_col) if length_col in docs.columns else None

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column(at)
        found = find(column, model)
        if not any(every for _, every, _ in found.values()):
            return batch
        text = column.to_pylist()
        length = batch.column(length_at).to_pylist() if length_at is not None else []
        for k, (_, every, _) in found.items():
            text[k] = masked(text[k], every)
            if every and length:
                length[k] = len(text[k])
        if length:
            batch = batch.set_column(length_at, batch.schema.field(length_at), pa.array(length, batch.schema.field(length_at).type))
        return batch.set_column(at, batch.schema.field(at), pa.array(text, column.type))

    return map_batches(docs, rows, schema)
