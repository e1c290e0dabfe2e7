"""Personal data: Aho-Corasick anchors, then local expansion and validation.

One automaton finds the places where a span can be: at-signs, schemes, plus
signs, digits and identifier cues.  Around each anchor a small deterministic
parser grows the span left and right and validates it; nothing else of the
text is looked at twice.  Kinds and their rules:

email    local part, at-sign, two or more labels
ip       four decimal parts, each at most 255
card     13 to 19 digits with single blanks or hyphens between, Luhn valid
phone    plus sign, 9 to 15 digits
account  IBAN (mod 97), or 6 to 18 digits after an account or identity cue
secret   quoted or bare value of 16 or more key characters after a key cue
login    user and password before the host of a scheme

The first four are leftmost and non-overlapping per kind; a match that fails
its check is passed over as a whole.  Offsets are code points, ends exclusive.

Defined results: a null text is an empty text and has no spans; rows that
repeat are each reported; very long texts take linear time and memory (one
text at a time); extra input columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from footfall.llm.common import id_text, table

KINDS = ("email", "ip", "card", "phone", "account", "secret", "login")
BASE = KINDS[:4]

_DIGITS = frozenset("0123456789")
_LABEL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-")
_LOCAL = _LABEL | frozenset("._%+")
_PHONE = _DIGITS | frozenset(" ().-")
_KEY = _LABEL | frozenset("_+/=.")
_ALNUM = _LABEL - {"-"}
_UPPER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ")

ACCOUNT_CUES = ("ssn", "iban", "account no", "account number", "acct", "passport")
SECRET_CUES = ("token", "api_key", "api key", "apikey", "secret", "password", "passwd", "access_key")


def build_automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for d in "0123456789":
        a.add_word(d, ("digit", 1))
    a.add_word("@", ("at", 1))
    a.add_word("+", ("plus", 1))
    a.add_word("://", ("scheme", 3))
    for cue in ACCOUNT_CUES:
        a.add_word(cue, ("account", len(cue)))
    for cue in SECRET_CUES:
        a.add_word(cue, ("secret", len(cue)))
    a.make_automaton()
    return a


def _run(text: str, i: int, allowed: frozenset) -> int:
    """First place from ``i`` on whose character is not allowed."""
    n = len(text)
    while i < n and text[i] in allowed:
        i += 1
    return i


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        if k % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def _email(text: str, at: int, low: int) -> tuple[int, int] | None:
    left = at
    while left > low and text[left - 1] in _LOCAL:
        left -= 1
    if left == at:
        return None
    end = _run(text, at + 1, _LABEL)
    if end == at + 1:
        return None
    labels = 1
    while end + 1 < len(text) and text[end] == "." and text[end + 1] in _LABEL:
        end = _run(text, end + 1, _LABEL)
        labels += 1
    return (left, end) if labels > 1 else None


def _ip(text: str, i: int) -> tuple[int, int, bool] | None:
    """(start, end, valid) of four dotted numbers that begin at ``i``."""
    start, parts = i, []
    while True:
        end = _run(text, i, _DIGITS)
        if end == i:
            return None
        parts.append(text[i:end].lstrip("0"))
        if len(parts) == 4:
            return start, end, all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)
        if end >= len(text) or text[end] != ".":
            return None
        i = end + 1


def _card(text: str, i: int) -> tuple[int, list[str]]:
    """End of the digits from ``i`` on, single blanks or hyphens between."""
    n, digits = len(text), []
    while True:
        end = _run(text, i, _DIGITS)
        digits.append(text[i:end])
        if end + 1 < n and text[end] in " -" and text[end + 1] in _DIGITS:
            i = end + 1
        else:
            return end, digits


def _phone(text: str, plus: int) -> tuple[int, int, bool] | None:
    if plus + 1 >= len(text) or text[plus + 1] not in _DIGITS:
        return None
    last = _run(text, plus + 2, _PHONE) - 1
    while last >= plus + 3 and text[last] not in _DIGITS:
        last -= 1
    if last < plus + 3:
        return None
    n_digits = sum(c in _DIGITS for c in text[plus:last + 1])
    return plus, last + 1, 9 <= n_digits <= 15


def _iban(text: str, i: int) -> tuple[int, int] | None:
    """Country letters before the digit at ``i``, groups of four after.  The
    longest valid number that ends a word is taken: after a blank the next
    word may go on in letters that could be a group."""
    start = i - 2
    if start < 0 or text[start] not in _UPPER or text[start + 1] not in _UPPER or (
            start > 0 and text[start - 1] in _ALNUM):
        return None
    code, ends, k = [], [], start
    while k < len(text) and len(code) < 34:
        c = text[k]
        if c in _UPPER or c in _DIGITS:
            code.append(c)
            if len(code) >= 15 and (k + 1 == len(text) or text[k + 1] not in _ALNUM):
                ends.append((len(code), k + 1))
        elif not (c == " " and len(code) % 4 == 0 and text[k - 1] != " "):
            break
        k += 1
    if len(code) < 15 or not (code[2] in _DIGITS and code[3] in _DIGITS):
        return None
    for size, end in reversed(ends):
        turned = "".join(str(int(c, 36)) for c in code[4:size] + code[:4])
        if int(turned) % 97 == 1:
            return start, end
    return None


def _after_cue(text: str, i: int) -> int:
    """Place after blanks, a colon or equal sign and a quote."""
    i = _run(text, i, frozenset(" \t"))
    if i < len(text) and text[i] in ":=#":
        i = _run(text, i + 1, frozenset(" \t"))
    return i + 1 if i < len(text) and text[i] in "\"'" else i


def _secret(text: str, cue_end: int) -> tuple[int, int] | None:
    i = _run(text, cue_end, frozenset(" \t\"'"))
    if i >= len(text) or text[i] not in ":=":
        return None
    start = _after_cue(text, i)
    end = _run(text, start, _KEY)
    value = text[start:end]
    return (start, end) if len(value) >= 16 and any(c in _DIGITS for c in value) else None


def _account(text: str, cue_end: int) -> tuple[int, int] | None:
    start = _after_cue(text, cue_end)
    if start >= len(text) or text[start] not in _DIGITS:
        return None
    end, digits = _card(text, start)
    return (start, end) if 6 <= sum(map(len, digits)) <= 18 else None


def _login(text: str, scheme: int) -> tuple[int, int] | None:
    start = scheme + 3
    end = start
    while end < len(text) and text[end] not in " \t\r\n/?#\"'<>@":
        end += 1
    inner = text[start:end]
    return (start, end) if end < len(text) and text[end] == "@" and ":" in inner.strip(":") else None


def find_spans(text: str, automaton: ahocorasick.Automaton) -> dict[str, list[tuple[int, int]]]:
    """Spans of every kind, each list in order of start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    free = dict.fromkeys(KINDS, 0)        # where the next match of a kind may start
    run_end = 0                           # digits before this place belong to a run already seen
    lowered = text.encode().lower().decode()      # A-Z alone: every place stays
    for last, (what, size) in automaton.iter(lowered):
        i = last - size + 1
        if what == "digit":
            if i < run_end:
                continue
            run_end = _run(text, i, _DIGITS)
            if i >= free["ip"] and (ip := _ip(text, i)):
                free["ip"] = ip[1]
                if ip[2]:
                    found["ip"].append(ip[:2])
            if i >= free["card"]:
                end, digits = _card(text, i)
                free["card"] = end
                joined = "".join(digits)
                if 13 <= len(joined) <= 19 and luhn(joined):
                    found["card"].append((i, end))
            if i >= free["account"] and (span := _iban(text, i)):
                free["account"] = span[1]
                found["account"].append(span)
        elif what == "at":
            if span := _email(text, i, free["email"]):
                free["email"] = span[1]
                found["email"].append(span)
        elif what == "plus":
            if i >= free["phone"] and (hit := _phone(text, i)):
                free["phone"] = hit[1]
                if hit[2]:
                    found["phone"].append(hit[:2])
        elif what == "scheme":
            if i >= free["login"] and (span := _login(text, i)):
                free["login"] = span[1]
                found["login"].append(span)
        elif what == "account":
            if (span := _account(text, last + 1)) and span[0] >= free["account"]:
                free["account"] = span[1]
                found["account"].append(span)
        elif (span := _secret(text, last + 1)) and span[0] >= free["secret"]:
            free["secret"] = span[1]
            found["secret"].append(span)
    return found


def _joined(spans: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in spans[k])


def redact(text: str, spans: dict[str, list[tuple[int, int]]]) -> str:
    """Text with each span replaced by <KIND>; overlapping spans become one,
    named after the kind listed first."""
    marks = sorted((a, b, n) for n, k in enumerate(KINDS) for a, b in spans[k])
    merged: list[tuple[int, int, int]] = []
    for a, b, n in marks:
        if merged and a < merged[-1][1]:
            a0, b0, n0 = merged[-1]
            merged[-1] = (a0, max(b0, b), min(n0, n))
        else:
            merged.append((a, b, n))
    out, at = [], 0
    for a, b, n in merged:
        out += [text[at:a], f"<{KINDS[n].upper()}>"]
        at = b
    return "".join(out) + text[at:]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts of the four base kinds, the hash of their
    spans and the string of all spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = build_automaton()
        for batch in batches:
            counts, base, spans = {k: [] for k in BASE}, [], []
            for text in batch.column(1):
                found = find_spans(text.as_py(), automaton)
                for k in BASE:
                    counts[k].append(len(found[k]))
                base.append(hashlib.sha256(_joined(found, BASE).encode()).hexdigest())
                spans.append(_joined(found, KINDS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(counts[k], pa.int64()) for k in BASE),
                 pa.array(base, pa.string()), pa.array(spans, pa.string())],
                names=["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"])

    src = id_text(docs, id_col, text_col)
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
                               "base_sha256 string, spans string")


def redact_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span in ``text_col`` replaced; a null text stays
    null; all other columns are untouched."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = build_automaton()
        for batch in batches:
            k = batch.schema.get_field_index(text_col)
            texts = [None if t is None else redact(t, find_spans(t, automaton))
                     for t in (x.as_py() for x in batch.column(k))]
            columns = list(batch.columns)
            columns[k] = pa.array(texts, batch.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def query(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"))
