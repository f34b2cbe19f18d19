"""Personal data by patterns and a linear-chain conditional random field.

Patterns find what is written in the usual way. A CRF over word shapes, trained
from a small labelled table, adds what is not: phone numbers without a plus
sign, cards of other lengths, addresses with letters beyond ASCII. What it adds
must hold up by the rules of its kind, and base spans always stay.

Only tokens with a digit or an at sign can be personal data here; all others
carry the label O by definition of the model. Sequences therefore fall apart
there without loss, and Viterbi runs over the short runs in between, all runs of
a block at once.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylog.llm.common import arrow_rows

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# Base patterns. Fixed values; the possessive and look-behind forms find the same and stay linear on long runs.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at sign to the left as far as the name goes, but not into the match before, and to the right."""
    low, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > low and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            low = domain.end()
            yield start, low
        at = text.find("@", max(at + 1, low))


def base_spans(text: str) -> list[Span]:
    """Spans of each kind, leftmost and not overlapping; matches that fail the kind's rule are dropped."""
    spans: list[Span] = [("email", *s) for s in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(n) <= 3 and int(n or 0) <= 255 for n in (p.lstrip("0") for p in m.group().split("."))):
                spans.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            if 16 <= m.end() - m.start() and 16 <= len(digits := _digits(m.group())) <= 19 and luhn(digits):
                spans.append(("card", *m.span()))
        if "+" in text:
            spans += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return spans


# The labelled table: <kind>...</kind> around what is personal data, everything else is not.
LABELLED = tuple(
    """
call <phone>(235) 555-3833</phone> before noon
my number is <phone>(030) 4417 2291</phone> or leave a note
phone <phone>555-201-7734</phone> for the office
tel <phone>0049 30 1234567</phone> daily
reach us at <phone>0171 5550123</phone> today
fax <phone>020 7946 0958</phone> and mail
mobile <phone>+44 20 7946 0958</phone> works too
dial <phone>+1 (726) 555-7857</phone> now
ring <phone>+49 (0) 30 901820</phone> first
phone <phone>1-800-555-0199</phone> toll free
call <phone>212.555.0147</phone> after six
tel <phone>(044) 668 18 00</phone> at the desk
card <card>4111 1111 1111 1111</card> was charged
paid by <card>3782 822463 10005</card> last week
amex <card>378282246310005</card> declined
visa <card>4012888888881881</card> on file
card number <card>5555-5555-5555-4444</card> expires soon
diners <card>3056 930902 5904</card> accepted
card <card>30569309025904</card> again
charge <card>6011 1111 1111 1117</card> please
write to <email>ann.lee@example.org</email> soon
mail <email>müller@beispiel-straße.de</email> for details
contact <email>josé@correo.example.es</email> please
email <email>info@münchen.example.de</email> today
from <email>bob+news@mail.example.com</email> yesterday
ask <email>rené.dupont@société.example.fr</email> again
server <ip>10.20.30.40</ip> is down
from <ip>192.168.1.77</ip> at night
host <ip>2001:db8:85a3::8a2e:370:7334</ip> answered
ping <ip>fe80::1ff:fe23:4567:890a</ip> again
peer <ip>2001:db8::1</ip> replied
node <ip>2a00:1450:4001:81b::200e</ip> is up
address <ip>203.0.113.9</ip> was blocked
the meeting is on 2024-01-15 at 12:30 in room 204
version 1.2.3 fixes 45 bugs in 10.15.7
it costs 49.99 or 1,299.00 in total
order 4785380592391141 has shipped
isbn 978-3-16-148410-0 second edition
chapter 12 section 3.4.1 page 1024
token 24be64439e3e49cf46b2d7c90f3602a3d0b907ff expired
from 1914 to 1918 and 1939-1945
score 3:2 after 90 minutes
id 00000000000000000000 is empty
between 10-20 and 30-40 percent
serial 8271-3345-9921-0042-7781 on the box
dated 15/03/2021 and 01.04.2022
follow @someone and @other2 there
room 12b floor 3 building 7
the ratio 355/113 is near 3.14159265
line 300.1.2.3 is no address
sum 1234567 units of 12345678 made
call me at 5 or at 6 today
item #48213 lot 7 of 12
2 + 2 = 4 and 10 - 3 = 7
in 1999 2004 and 2010 it rained
row 1 2 3 4 5 6 7 8 9 10
zip 84101 or 10115 berlin
utc 2024-01-15T12:30:45 stamp
sha 9f86d081884c7d659a2feaa0c55ad015 matches
""".strip().splitlines()
)

LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
_TAG = re.compile(r"<(/?)(email|ip|card|phone)>")
_MARKED = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
_TRAIL, _LEAD = ".,;:!?)\"'»”]", "\"'«“[<"
Token = tuple[int, int]


def _shape(token: str) -> str:
    """Letters, digits and marks as runs: ``(235)`` is ``(d)``, ``ann@x.org`` is ``x@x.x``."""
    made: list[str] = []
    for c in token:
        kind = "d" if "0" <= c <= "9" else "X" if c.isupper() else "x" if c.isalpha() else c
        if not made or made[-1] != kind:
            if len(made) == 24:
                break
            made.append(kind)
    return "".join(made)


def _outline(text: str, run: list[Token]) -> list[tuple[str, int]]:
    """Shape and number of digits of every token of a run, however long."""
    tokens = [text[start:end] for start, end in run]
    return [(_shape(token.rstrip(_TRAIL[:6])), len(_digits(token))) for token in tokens]


def runs(text: str) -> list[list[Token]]:
    """Marked tokens, as runs with nothing but a little space in between, on one line."""
    found: list[list[Token]] = []
    end = -9
    for m in _MARKED.finditer(text):
        start = m.start()
        near = 0 < start - end <= 2 and "\n" not in text[end:start]
        if near:
            found[-1].append(m.span())
        else:
            found.append([m.span()])
        end = m.end()
    return found


def _features(text: str, run: list[Token], i: int, outline: list[tuple[str, int]]) -> list[str]:
    """Word-shape features of a token, of its neighbours in the run, and the word before the run."""
    shape, digits = outline[i]
    marks = "".join(c for c in shape if c not in "dxX")
    made = [f"shape={shape}", f"digits={min(digits, 20)}", f"both={shape}/{digits}", f"marks={marks}"]
    made.append(f"kinds={''.join(sorted(set(marks)))}/{min(len(marks), 3)}")
    for name, j in (("before", i - 1), ("after", i + 1)):
        if 0 <= j < len(run):
            other, count = outline[j]
            made += [f"{name}={other}", f"{name}-digits={min(count, 20)}"]
        else:
            made.append(f"{name}=none")
    if i == 0:
        word = text[max(0, run[0][0] - 24) : run[0][0]].split()[-1:]
        made.append(f"word={word[0].lower().strip(':') if word else ''}")
    total = sum(count for _, count in outline) if len(run) <= 8 else 99
    made.append(f"run-digits={min(total, 24)}")
    return made


class Field:
    """Weights of features per label, and of label pairs."""

    def __init__(self, features: dict[str, int], emit: np.ndarray, move: np.ndarray) -> None:
        self.features, self.emit, self.move = features, emit, move

    def emissions(self, text: str, run: list[Token]) -> np.ndarray:
        rows, outline = np.zeros((len(run), len(LABELS))), _outline(text, run)
        for i in range(len(run)):
            known = [k for f in _features(text, run, i, outline) if (k := self.features.get(f)) is not None]
            rows[i] = self.emit[known].sum(axis=0)
        return rows

    def decode(self, emissions: list[np.ndarray]) -> list[np.ndarray]:
        """Best labels of every run by Viterbi; runs of like length advance together."""
        made: list[np.ndarray] = [np.empty(0, int)] * len(emissions)
        order = sorted(range(len(emissions)), key=lambda i: -len(emissions[i]))
        for at in range(0, len(order), 512):
            group = order[at : at + 512]
            lengths = np.array([len(emissions[i]) for i in group])
            score = np.stack([emissions[i][0] for i in group]) + self.move[-1]
            back = np.zeros((lengths[0], len(group), len(LABELS)), np.int8)
            for t in range(1, lengths[0]):
                going = int((lengths > t).sum())
                options = score[:going, :, None] + self.move[None, :-1]
                back[t, :going] = options.argmax(axis=1)
                score[:going] = options.max(axis=1) + np.stack([emissions[i][t] for i in group[:going]])
            label = score.argmax(axis=1)
            path = np.zeros((lengths[0], len(group)), int)
            for t in range(lengths[0] - 1, -1, -1):
                going = lengths > t
                path[t, going] = label[going]
                if t:
                    label = np.where(going, back[t, np.arange(len(group)), label], label)
            for column, i in enumerate(group):
                made[i] = path[: lengths[column], column]
        return made


def _allowed() -> np.ndarray:
    """Which label may follow which, the last row for the beginning: inside only goes on what has begun."""
    ok = np.ones((len(LABELS) + 1, len(LABELS)), bool)
    for j, label in enumerate(LABELS):
        if label[0] == "I":
            ok[:, j] = [other[2:] == label[2:] for other in LABELS] + [False]
    return ok


def examples(lines: list[str]) -> list[tuple[str, list[Token], list[int]]]:
    """Runs of marked tokens of labelled lines, with a label for every token."""
    made = []
    for line in lines:
        text, spans, at, begun = "", [], 0, 0
        for m in _TAG.finditer(line):
            text += line[at : m.start()]
            if m[1]:
                spans.append((m[2], begun, len(text)))
            begun, at = len(text), m.end()
        text += line[at:]
        for run in runs(text):
            labels = []
            for start, end in run:
                inside = next(((k, s) for k, s, e in spans if start < e and end > s), None)
                labels.append(LABELS.index(("B-" if inside[1] >= start else "I-") + inside[0]) if inside else 0)
            made.append((text, run, labels))
    return made


def train(lines: list[str], steps: int = 150, rate: float = 0.1, ridge: float = 0.02) -> Field:
    """Maximum likelihood with a ridge, by Adam on the gradient of forward and backward sums. Alike in every run."""
    data = examples(lines)
    described = [[_features(text, run, i, _outline(text, run)) for i in range(len(run))] for text, run, _ in data]
    features = {f: i for i, f in enumerate(sorted({f for d in described for token in d for f in token}))}
    index = [[[features[f] for f in token] for token in d] for d in described]
    closed = np.where(_allowed(), 0.0, -1e4)
    weights = [np.zeros((len(features), len(LABELS))), np.zeros_like(closed)]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    n = len(LABELS)

    def total(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)

    for step in range(1, steps + 1):
        emit, move = weights[0], weights[1] + closed
        gradient = [-ridge * weights[0], -ridge * weights[1]]
        for (_, _, labels), tokens in zip(data, index):
            score = np.stack([emit[t].sum(axis=0) for t in tokens])
            forward, backward = [move[n] + score[0]], [np.zeros(n)]
            for t in range(1, len(tokens)):
                forward.append(total(forward[-1][:, None] + move[:n], 0) + score[t])
            for t in range(len(tokens) - 1, 0, -1):
                backward.insert(0, total(move[:n] + (score[t] + backward[0])[None, :], 1))
            whole = total(forward[-1], 0)
            for t, (label, token) in enumerate(zip(labels, tokens)):
                miss = -np.exp(forward[t] + backward[t] - whole)
                miss[label] += 1.0
                np.add.at(gradient[0], token, miss)
                if t:
                    gradient[1][:n] -= np.exp(forward[t - 1][:, None] + move[:n] + (score[t] + backward[t])[None, :] - whole)
                    gradient[1][labels[t - 1], label] += 1.0
                else:
                    gradient[1][n] += miss
        for w, g, (first, second) in zip(weights, gradient, moments):
            first += 0.1 * (g - first)
            second += 0.001 * (g * g - second)
            w += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Field(features, weights[0], weights[1] + closed)


def _holds(kind: str, text: str) -> bool:
    """The rules of each kind for what the field adds."""
    digits = _digits(text)
    if kind == "email":
        name, _, domain = text.partition("@")
        return bool(name) and "@" not in domain and "." in domain.strip(".") and not any(c.isspace() for c in text)
    if kind == "ip":
        try:
            return ":" in text and text.count(":") >= 2 and bool(ipaddress.IPv6Address(text))
        except ValueError:
            return False
    if kind == "card":
        plain = all(c.isdigit() or c in " -." for c in text)
        return plain and 13 <= len(digits) <= 19 and digits[0] in "3456" and luhn(digits)
    plain = all(c.isdigit() or c in " ()-./+" for c in text)
    return plain and 9 <= len(digits) <= 15 and any(c in text for c in " ()-./") and text[0] in "(+0123456789"


def added_spans(texts: list[str], base: list[list[Span]], field: Field) -> list[list[Span]]:
    """What the field finds beyond base spans, for all texts of a block."""
    where, emissions = [], []
    for number, text in enumerate(texts):
        for run in runs(text):
            if any(all(s <= a and b - (text[b - 1] in _TRAIL) <= e for a, b in run) for _, s, e in base[number]):
                continue  # lies in one base span; nothing to add
            where.append((number, run))
            emissions.append(field.emissions(text, run))
    made: list[list[Span]] = [[] for _ in texts]
    for (number, run), labels in zip(where, field.decode(emissions)):
        text, at = texts[number], 0
        while at < len(run):
            label = LABELS[labels[at]]
            end = at + 1
            while end < len(run) and label != "O" and LABELS[labels[end]] == f"I-{label[2:]}":
                end += 1
            if label != "O":
                start, stop = run[at][0], run[end - 1][1]
                while start < stop and text[start] in _LEAD:
                    start += 1
                while start < stop and text[stop - 1] in _TRAIL:
                    stop -= 1
                free = all(stop <= s or start >= e for _, s, e in base[number])
                if start < stop and free and _holds(label[2:], text[start:stop]):
                    made[number].append((label[2:], start, stop))
            at = end
    return made


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


def find_personal_data(docs: DataFrame, labelled: tuple[str, ...] = LABELLED, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One line per row: ``doc_id, spans`` (base) and ``added``, arrays of ``kind, start, end`` in code points.

    Null texts count as empty and have no spans; ids, null or repeated, are
    passed through; other columns are not read. ``labelled`` is the table the
    field is trained from, on the driver: some dozen lines.
    """
    field = train(list(labelled))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))

    def work(block: dict[str, list]) -> dict[str, list]:
        texts = [t or "" for t in block["text"]]
        base = [base_spans(t) for t in texts]
        added = added_spans(texts, base, field)

        def listed(spans: list[Span]) -> list[dict]:
            return [{"kind": k, "start": s, "end": e} for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1]))]

        return {"doc_id": block["doc_id"], "spans": [listed(b) for b in base], "added": [listed(a) for a in added]}

    entry = "array<struct<kind: string, start: long, end: long>>"
    return arrow_rows(rows, work, f"doc_id long, spans {entry}, added {entry}")


def personal_data_digest(found: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added``; counts are of base spans."""
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    place = lambda s: F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"])
    order = lambda s: F.struct(place(s).alias("place"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    whole = F.array_sort(F.transform(F.concat("spans", "added"), order))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id", *[count(k) for k in KINDS],
        F.sha2(text(F.col("spans")), 256).alias("base_sha256"),
        text(whole).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def redact(docs: DataFrame, labelled: tuple[str, ...] = LABELLED, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, text`` with every span replaced by its kind in angle brackets; where base spans overlap, the first to begin."""
    field = train(list(labelled))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))

    def work(block: dict[str, list]) -> dict[str, list]:
        texts = [t or "" for t in block["text"]]
        base = [base_spans(t) for t in texts]
        made = []
        for text, spans, more in zip(texts, base, added_spans(texts, base, field)):
            parts, at = [], 0
            for kind, start, end in sorted(spans + more, key=lambda x: (x[1], -x[2])):
                if start >= at:
                    parts += [text[at:start], f"<{kind}>"]
                    at = end
            made.append("".join([*parts, text[at:]]))
        return {"doc_id": block["doc_id"], "text": made}

    return arrow_rows(rows, work, "doc_id long, text string")
