"""Personal data in texts: fixed patterns, and a linear-chain conditional random field.

The patterns find what is written in full. The field labels word shapes, is trained from a small
labelled table, and adds what the patterns leave out, such as spelled-out mail addresses and
phone numbers without a country code. It looks at the surroundings of digits, ``@``, a spelled
``dot`` and a spelled ``at`` before words joined by dots; all other words are outside by definition.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe.llm.common import schema_of

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# --- Fixed patterns -------------------------------------------------------------------------

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits that fails does so from each of its digits, so only its first is tried.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each ``@`` outwards: linear however long a run of letters is."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text, start - 1):
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def is_ip(parts: Sequence[str]) -> bool:
    short = [p.lstrip("0") for p in parts]
    return len(short) == 4 and all(len(p) <= 3 and int(p or "0") <= 255 for p in short)


def digits_of(text: str) -> str:
    return "".join(re.findall("[0-9]", text))


def is_card(text: str) -> bool:
    digits = digits_of(text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def base_spans(text: str) -> list[Span]:
    """What the fixed patterns find, by kind and start; matches that fail their test are dropped."""
    out: list[Span] = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if not re.search("[0-9]", text):
        return out
    out += [("ip", *m.span()) for m in IP.finditer(text) if is_ip(m[0].split("."))] if "." in text else []
    out += [("card", *m.span()) for m in CARD.finditer(text) if is_card(m[0])]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15] if "+" in text else []
    return out


def written(spans: list[Span]) -> str:
    order = {k: i for i, k in enumerate(KINDS)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (order[s[0]], s[1], s[2])))


# --- The field ------------------------------------------------------------------------------

LABELS = ("O", *[f"{p}-{k}" for k in KINDS for p in "BI"])
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_")
#: Where to look: digits, @, and "dot" as a word.
ANCHOR = re.compile(r"[0-9@]|(?<![A-Za-z])[Dd][Oo][Tt](?![A-Za-z])")
#: "at" as a word, and what may follow it: marks and blanks, then words joined by dots and hyphens.
SPELLED_AT = re.compile(r"(?<![A-Za-z])[Aa][Tt](?![A-Za-z])")
JOINED = re.compile(r"[\W_]*+([^\W_]++(?:[.-]++[^\W_]++)*+)")
_AT = r"(?:\s?@\s?|\s?[(\[{]\s?(?:at|@)\s?[)\]}]\s?|\s(?:at|@)\s)"
_DOT = r"(?:\.|\s?[(\[{]\s?(?:dot|\.)\s?[)\]}]\s?|\sdot\s)"
#: An address as people write it, with or without spelled parts; only what the field marks is looked up.
ADDRESS = re.compile(
    rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-][A-Za-z0-9._%+-]*+(?:{_DOT}[A-Za-z0-9_%+-]++)*+{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++", re.I
)
REST = re.compile(r"[^\W_]*+(?:[.-]++[^\W_]++)*+")
#: Tokens on either side of an anchor that are decoded with it.
REACH = 8
#: Windows decoded together.
DECODED = 512
#: Labelled texts that training takes; a documented bound, the table is meant to be small.
LABELLED_ROWS = 10_000
#: A word outside of marks is known by its spelling if at least so many labelled texts hold it.
WORD_TEXTS = 3
#: Words that join the parts of a spelled address; they may stand inside a mark.
JOINTS = ("at", "dot")
#: Tokens that a number written in groups may hold beside digits, and how far before it a word counts.
GROUPING = frozenset("()[]{}+-./")
CUE_REACH = 5


@lru_cache(maxsize=1 << 16)
def shape(token: str) -> tuple[str, str, str]:
    """The shape of a token, a coarser one, and its spelling if it is a word."""
    if token.isdecimal():
        return f"{'0' if token[0] == '0' and len(token) > 1 else 'd'}{min(len(token), 17)}", "d", ""
    if token.isalpha():
        low = token.lower()
        return "X" if token.isupper() else "Xx" if token[0].isupper() else "x", low if low in JOINTS else "x", low
    return token, token, ""


def lexicon(labelled: list[tuple[str, list[Span]]]) -> frozenset[str]:
    """Words whose spelling is a feature; all others, such as names inside marks, are known by shape alone."""
    seen: dict[str, int] = {}
    for text, spans in labelled:
        tokens = [m for m in TOKEN.finditer(text) if not any(a <= m.start() < b for _, a, b in spans)]
        for word in {m[0].lower() for m in tokens if m[0].isalpha()}:
            seen[word] = seen.get(word, 0) + 1
    return frozenset([w for w, n in seen.items() if n >= WORD_TEXTS]) | frozenset(JOINTS)


#: Features of each token.
WIDTH = 14


def features(text: str, tokens: list[tuple[int, int]], words: frozenset[str] = frozenset(JOINTS)) -> list[list[str]]:
    """What the field sees of each token; ``words`` are known by their spelling."""
    shapes = [shape(text[a:b]) for a, b in tokens]
    gaps = ["" if i and tokens[i - 1][1] == tokens[i][0] else "_" for i in range(len(tokens))] + ["_"]
    # Each neighbour is written with the gap between it and the token before.
    fine = ["<", "<", *[g + (w if w in words else s) for g, (s, _, w) in zip(gaps, shapes, strict=False)], ">", ">", ">"]
    coarse = ["<", "<", *[g + c for g, (_, c, _) in zip(gaps, shapes, strict=False)], ">", ">", ">"]
    runs, cues = [""] * len(tokens), [""] * len(tokens)
    i = 0
    while i < len(tokens):
        k = i
        while k < len(tokens) and (shapes[k][1] == "d" or shapes[k][0] in GROUPING):
            k += 1
        if k > i and any(s[1] == "d" for s in shapes[i:k]):
            # The groups of a number as a whole, and the nearest known word before it.
            runs[i:k] = [" ".join(fine[i + 2 : min(k, i + 24) + 2])] * (k - i)
            cue = next((w for _, _, w in reversed(shapes[max(0, i - CUE_REACH) : i]) if w in words), "")
            cues[i:k] = [cue] * (k - i)
        i = max(k, i + 1)
    out = []
    for j in range(2, len(tokens) + 2):
        run, cue = runs[j - 2], cues[j - 2]
        out.append(
            [
                f"0:{fine[j]}",
                f"-:{fine[j - 1]}",
                f"+:{fine[j + 1]}",
                f"-0:{fine[j - 1]} {fine[j]}",
                f"0+:{fine[j]} {fine[j + 1]}",
                f"--:{fine[j - 2]} {fine[j - 1]}",
                f"++:{fine[j + 1]} {fine[j + 2]}",
                f"c3:{coarse[j - 1]} {coarse[j]} {coarse[j + 1]}",
                f"c+:{coarse[j]} {coarse[j + 1]} {coarse[j + 2]} {coarse[j + 3]}",
                f"c-:{coarse[j - 2]} {coarse[j - 1]} {coarse[j]}",
                f"f3:{fine[j - 1]} {fine[j]} {fine[j + 1]}",
                f"r:{run}",
                f"w:{cue}",
                f"wr:{cue} {run}",
            ]
        )
    return out


@dataclass
class Field:
    """Weights per feature and label, and per pair of labels."""

    index: dict[str, int]
    emit: np.ndarray
    step: np.ndarray
    words: frozenset[str] = frozenset(JOINTS)

    def features(self, text: str, tokens: list[tuple[int, int]]) -> list[list[str]]:
        return features(text, tokens, self.words)

    def rows(self, found: list[list[str]]) -> np.ndarray:
        """Scores of the labels of each token; features not seen in training weigh nothing."""
        out = np.zeros((len(found), len(LABELS)))
        for t, names in enumerate(found):
            known = [i for n in names if (i := self.index.get(n)) is not None]
            if known:
                out[t] = self.emit[known].sum(axis=0)
        return out

    def decode(self, scores: list[np.ndarray]) -> list[np.ndarray]:
        """The best labels of each window, by Viterbi over all windows at once."""
        sizes = np.array([len(s) for s in scores])
        n, longest, labels = len(scores), int(sizes.max()), len(LABELS)
        padded = np.zeros((n, longest, labels))
        for i, s in enumerate(scores):
            padded[i, : len(s)] = s
        best = padded[:, 0].copy()
        best[:, [i for i, name in enumerate(LABELS) if name[0] == "I"]] = -np.inf
        back = np.zeros((longest, n, labels), np.int8)
        for t in range(1, longest):
            paths = best[:, :, None] + self.step[None]
            back[t] = paths.argmax(axis=1)
            new = paths.max(axis=1) + padded[:, t]
            best = np.where((t < sizes)[:, None], new, best)
        at = best.argmax(axis=1)
        out = [np.zeros(size, np.int8) for size in sizes]
        for t in range(longest - 1, -1, -1):
            here = np.flatnonzero(t < sizes)
            for i in here:
                out[i][t] = at[i]
            at[here] = back[t, here, at[here]]
        return out


def _forbidden() -> np.ndarray:
    """An inside label follows only its own kind."""
    bad = np.zeros((len(LABELS), len(LABELS)), bool)
    for j, name in enumerate(LABELS):
        if name[0] == "I":
            bad[:, j] = [label[2:] != name[2:] for label in LABELS]
    return bad


def _log_times(logs: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Logarithms of rows times a matrix, the rows given as logarithms."""
    most = logs.max(axis=1, keepdims=True)
    return most + np.log(np.maximum(np.exp(logs - most) @ steps, 1e-300))


def train(labelled: list[tuple[str, list[Span]]], rounds: int = 100, decay: float = 0.01) -> Field:
    """Weights of highest penalised likelihood, by gradient steps over the whole table."""
    index: dict[str, int] = {}
    texts = []
    words = lexicon(labelled)
    for text, spans in labelled:
        tokens = [m.span() for m in TOKEN.finditer(text)]
        if not tokens:
            continue
        names = [[index.setdefault(n, len(index)) for n in row] for row in features(text, tokens, words)]
        gold = np.zeros(len(tokens), int)
        for kind, a, b in spans:
            inside = [i for i, (x, y) in enumerate(tokens) if x >= a and y <= b]
            for k, i in enumerate(inside):
                gold[i] = LABELS.index(f"{'I' if k else 'B'}-{kind}")
        texts.append((np.array(names), gold))
    size = len(LABELS)
    forbidden = _forbidden()
    weights = [np.zeros((len(index), size)), np.where(forbidden, -1e4, 0.0)]
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in weights]
    lengths = np.array([len(g) for _, g in texts])
    longest = int(lengths.max(initial=1))
    # Padding tokens use a feature of their own, which stays at zero.
    table = np.full((len(texts), longest, WIDTH), len(index))
    gold = np.zeros((len(texts), longest), int)
    for i, (names, g) in enumerate(texts):
        table[i, : len(g)], gold[i, : len(g)] = names, g
    real = np.arange(longest) < lengths[:, None]
    for round_ in range(1, rounds + 1):
        emit = np.vstack([weights[0], np.zeros((1, size))])
        scores = sum(emit[table[:, :, f]] for f in range(WIDTH))
        alpha = np.zeros_like(scores)
        beta = np.zeros_like(scores)
        alpha[:, 0] = scores[:, 0]
        steps = np.exp(weights[1])
        for t in range(1, longest):
            way = _log_times(alpha[:, t - 1], steps) + scores[:, t]
            alpha[:, t] = np.where(real[:, t, None], way, alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            beta[:, t] = np.where(real[:, t + 1, None], _log_times(scores[:, t + 1] + beta[:, t + 1], steps.T), 0.0)
        whole = np.logaddexp.reduce(alpha[:, -1], axis=1)
        share = np.exp(alpha + beta - whole[:, None, None]) * real[:, :, None]
        share[np.arange(len(texts))[:, None], np.arange(longest)[None], gold] -= real
        emit_up = np.zeros((len(index) + 1, size))
        flat = share.reshape(-1, size)
        for k in range(size):
            emit_up[:, k] = np.bincount(table.ravel(), np.repeat(flat[:, k], WIDTH), len(index) + 1)
        step_up = np.zeros((size, size))
        for t in range(1, longest):
            left, right = alpha[:, t - 1], scores[:, t] + beta[:, t]
            least, most = left.max(axis=1, keepdims=True), right.max(axis=1, keepdims=True)
            weight = np.exp(least + most - whole[:, None]) * real[:, t, None]
            step_up += steps * ((np.exp(left - least) * weight).T @ np.exp(right - most))
            np.add.at(step_up, (gold[real[:, t], t - 1], gold[real[:, t], t]), -1.0)
        for w, up, (mean, square) in zip(weights, (emit_up[:-1], step_up), moments, strict=True):
            up = up + decay * np.where(w < -1e3, 0.0, w)
            mean[:] = 0.9 * mean + 0.1 * up
            square[:] = 0.99 * square + 0.01 * up * up
            w -= 0.1 * (mean / (1 - 0.9**round_)) / (np.sqrt(square / (1 - 0.99**round_)) + 1e-8)
        weights[1][forbidden] = -1e4
    return Field(index, weights[0], weights[1], words)


MARKED = re.compile(r"\[\[(\w+)\|(.*?)\]\]")


def parse_marked(line: str) -> tuple[str, list[Span]]:
    """A text and its spans from a line with marks such as ``[[phone|(030) 555-2368]]``."""
    text, spans, at = "", [], 0
    for m in MARKED.finditer(line):
        text += line[at : m.start()]
        spans.append((m[1], len(text), len(text) + len(m[2])))
        text += m[2]
        at = m.end()
    return text + line[at:], spans


def train_from(labelled: DataFrame, marked_col: str = "marked") -> Field:
    """Train from a table of marked texts, of which at most ``LABELLED_ROWS`` are taken, in their order of text."""
    rows = labelled.select(marked_col).where(F.col(marked_col).isNotNull()).orderBy(marked_col).limit(LABELLED_ROWS)
    return train([parse_marked(r[0]) for r in rows.collect()])


def spelled_at(text: str) -> list[int]:
    """Anchors of a spelled ``at`` before words joined by a dot: itself, and every joint of the words before and after it.

    So the window holds the whole address, however many parts it has. Each character is read a
    bounded number of times.
    """
    out: list[int] = []
    first = end = dot = done = 0
    for m in SPELLED_AT.finditer(text):
        # Another "at" inside the same joined words has the same end.
        if m.end() > end or m.start() < first:
            found = JOINED.match(text, m.end())
            if not found:
                continue
            first, end = found.span(1)
            dot = text.rfind(".", first, end)
        if dot < m.end():
            continue
        start = m.start()
        while start > done and not text[start - 1].isalnum():
            start -= 1
        while start > done and LOCAL.match(text, start - 1):
            start -= 1
        out.append(m.start())
        out += [i for i in range(max(start, done), m.start()) if text[i] in "._%+-"]
        out += [i for i in range(max(m.end(), done), end) if text[i] in ".-"]
        done = max(done, end)
    return sorted(set(out))


def windows(text: str) -> list[list[tuple[int, int]]]:
    """The tokens around anchors; surroundings that meet are one window."""
    anchors = [m.start() for m in ANCHOR.finditer(text)]
    if spelled := spelled_at(text):
        anchors = sorted({*anchors, *spelled})
    if not anchors:
        return []
    out: list[list[tuple[int, int]]] = []
    tokens: list[tuple[int, int]] = []
    until, before = -1, []
    k = 0
    # Tokens are read once, from a little before the first anchor on.
    start = max(0, anchors[0] - 400)
    while start > 0 and not text[start].isspace():
        start -= 1
    for m in TOKEN.finditer(text, start):
        hit = False
        while k < len(anchors) and anchors[k] < m.end():
            hit = hit or anchors[k] >= m.start()
            k += 1
        if hit:
            if not tokens:
                tokens = before[-REACH:]
            # Twice the reach: the next anchor may bring its own surroundings.
            until = 2 * REACH
        if until >= 0 and (tokens or hit):
            tokens.append(m.span())
            until -= 1
            if until < 0:
                out.append(tokens[:-REACH])
                tokens, before = [], tokens[-REACH:]
                if k >= len(anchors):
                    break
        else:
            before = [*before[-REACH:], m.span()]
    if tokens:
        out.append(tokens)
    return out


def plausible(kind: str, text: str) -> bool:
    """What a span of the field must hold to be added."""
    if kind == "email":
        low = text.lower()
        return ("@" in text or re.search(r"(?<![a-z])at(?![a-z])", low) is not None) and (
            "." in text or re.search(r"(?<![a-z])dot(?![a-z])", low) is not None
        )
    if kind == "ip":
        return is_ip(re.findall("[0-9]+", text))
    if kind == "card":
        return is_card(text)
    return 9 <= len(digits_of(text)) <= 15


def whole_addresses(text: str, spans: list[Span], start: int, end: int) -> list[Span]:
    """Mail spans of the field, each grown or cut to the written addresses that it meets in ``text[start:end]``.

    So one never ends inside a word, and two addresses are two spans. One that meets none stays.
    """
    if not any(k == "email" for k, *_ in spans):
        return spans
    while start > 0 and LOCAL.match(text, start - 1):
        start -= 1
    written_out = [m.span() for m in ADDRESS.finditer(text, start, end)]
    out: list[Span] = []
    for kind, a, b in spans:
        met = [(kind, x, y) for x, y in written_out if x < b and a < y] if kind == "email" else []
        out += met or [(kind, a, b)]
    return list(dict.fromkeys(out))


def read_labels(text: str, tokens: list[tuple[int, int]], labels: np.ndarray) -> list[Span]:
    out: list[Span] = []
    for (a, b), label in zip(tokens, labels.tolist(), strict=True):
        name = LABELS[label]
        if name[0] == "B":
            out.append((name[2:], a, b))
        elif name[0] == "I" and out:
            out[-1] = (name[2:], out[-1][1], b)
    if tokens:
        # The words at the window's ends go on to their next blank.
        out = whole_addresses(text, out, tokens[0][0], REST.match(text, tokens[-1][1]).end())
    return [s for s in out if plausible(s[0], text[s[1] : s[2]])]


def find_personal_data(
    docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, base, added`` per row: arrays of (kind, start, end) in code points, end exclusive.

    ``base`` holds what the fixed patterns find, ``added`` the spans of the field that touch none
    of them. A null text is empty and has none; rows that repeat and null ids are rows like others,
    other columns are left out, and an empty table gives no rows. Texts are read whole, however long.
    Rows stay in their tasks; the field (bounded by its labelled table) goes to all.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value

        for batch in batches:
            base: list[list[Span]] = []
            added: list[list[Span]] = [[] for _ in range(batch.num_rows)]
            held: list[tuple[int, str, list[tuple[int, int]]]] = []

            def decode() -> None:
                # Windows of like length share a batch, so that padding stays small.
                held.sort(key=lambda h: len(h[2]))
                for at in range(0, len(held), DECODED):
                    group = held[at : at + DECODED]
                    labels = model.decode([model.rows(model.features(t, w)) for _, t, w in group])
                    for (i, text, tokens), own in zip(group, labels, strict=True):
                        added[i] += read_labels(text, tokens, own)
                held.clear()

            for i, scalar in enumerate(batch.column(1)):
                text = scalar.as_py() or ""
                base.append(base_spans(text))
                held += [(i, text, w) for w in windows(text)]
                if len(held) >= 8 * DECODED:
                    decode()
            if held:
                decode()
            for i, spans in enumerate(added):
                taken = sorted((a, b) for _, a, b in base[i])
                ends = np.maximum.accumulate([b for _, b in taken]) if taken else []
                starts = [a for a, _ in taken]
                free = []
                for s in sorted(spans, key=lambda s: s[1]):
                    k = np.searchsorted(starts, s[2])
                    if not k or ends[k - 1] <= s[1]:
                        free.append(s)
                added[i] = free
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *[pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in row] for row in side], kind) for side in (base, added)],
                ],
                [id_col, "base", "added"],
            )

    spans = T._parse_datatype_string("array<struct<kind: string, start: long, end: long>>")
    rows = docs.select(id_col, text_col)
    return rows.mapInArrow(find, schema_of(docs.select(id_col), ("base", spans), ("added", spans)))


def written_spans(spans):
    """``kind:start:end`` by kind as listed, then start, comma-joined: as a column."""
    order = F.array(*[F.lit(k) for k in KINDS])
    ranked = F.transform(spans, lambda s: F.struct(F.array_position(order, s["kind"]).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(ranked), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
