"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits,
URL schemes, and words that announce an account, a credential or an address.
Each anchor calls a small parser that expands to the left and right, finds the
exact boundaries and validates the value.  Nothing else of the text is parsed.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "account", "credential", "address")
RANK = {kind: i for i, kind in enumerate(KINDS)}

# Words that announce a value, and street words.
SCHEMES = ("http://", "https://", "ftp://")
ACCOUNT_CUES = ("iban", "account", "acct", "konto", "compte", "cuenta", "routing")
CREDENTIAL_CUES = ("token", "secret", "password", "api_key", "apikey", "AKIA")
STREETS = (" street", " avenue", " road", " lane", " boulevard", " drive")

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
DIGITS = re.compile(r"[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
URL = re.compile(r"(?:https?|ftp)://[^\s<>\"']*[^\s<>\"'.,;:!?)]", re.IGNORECASE)
ACCOUNT = re.compile(r"[\s:#.]*(?:(?:number|no|nr)\b[\s:#.]*)?([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){10,30}|[0-9](?:[ -]?[0-9]){5,29})\b", re.IGNORECASE)
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{10,30}")
SECRET = re.compile(r"\s*[:=]\s*[\"']?([A-Za-z0-9+/_-]{16,})[\"']?")
ACCESS_KEY = re.compile(r"AKIA[A-Z0-9]{16}(?![A-Za-z0-9])")
NAME = re.compile(r"[A-Za-z.'-]")
HOUSE = re.compile(r"(?<![A-Za-z0-9])[0-9]{1,5}[A-Za-z]?$")
NAMES = 4  # words between the house number and the street word, at most


def automaton():
    """Anchors in lower, upper and title case with the parser they call."""
    import ahocorasick
    found = ahocorasick.Automaton()
    found.add_word("@", ("@", 1))
    found.add_word("+", ("+", 1))
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    for kind, words in (("url", SCHEMES), ("account", ACCOUNT_CUES), ("credential", CREDENTIAL_CUES), ("address", STREETS)):
        for word in words:
            for form in {word, word.lower(), word.upper(), word.title()}:
                found.add_word(form, (kind, len(word)))
    found.make_automaton()
    return found


_AUTOMATON = []


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every finding, in code points, ordered by start and kind."""
    if not text:
        return []
    if not _AUTOMATON:
        _AUTOMATON.append(automaton())
    out: list[tuple[str, int, int]] = []
    after = dict.fromkeys(("email", "ip", "card", "phone"), 0)  # where the next match of a kind may begin
    for last, (anchor, size) in _AUTOMATON[0].iter(text):
        at = last - size + 1
        if anchor == "digit":
            if at >= after["card"]:
                run = CARD.match(text, at)
                after["card"] = run.end() if run else at + 1
                if run and is_card(run.group()):
                    out.append(("card", at, run.end()))
            if at >= after["ip"]:
                run = IP.match(text, at)
                after["ip"] = run.end() if run else DIGITS.match(text, at).end()
                if run and all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in run.groups()):
                    out.append(("ip", at, run.end()))
        elif anchor == "+":
            if at >= after["phone"] and (run := PHONE.match(text, at)):
                after["phone"] = run.end()
                if 9 <= sum(c.isdigit() for c in run.group()) <= 15:
                    out.append(("phone", at, run.end()))
        elif anchor == "@":
            start = at
            while start > after["email"] and LOCAL.match(text, start - 1):
                start -= 1
            if start < at and (run := DOMAIN.match(text, at + 1)):
                after["email"] = run.end()
                out.append(("email", start, run.end()))
        elif anchor == "url":
            if run := URL.match(text, at):
                out.append(("url", at, run.end()))
        elif anchor == "account":
            run = ACCOUNT.match(text, last + 1)
            if run and is_account(run.group(1)):
                out.append(("account", *run.span(1)))
        elif anchor == "credential":
            if run := ACCESS_KEY.match(text, at):
                out.append(("credential", *run.span()))
            elif run := SECRET.match(text, last + 1):
                out.append(("credential", *run.span(1)))
        elif anchor == "address" and not text[last + 1:last + 2].isalnum():
            if (begin := house_before(text, at)) is not None:
                out.append(("address", begin, last + 1))
    return sorted(set(out), key=lambda s: (s[1], RANK[s[0]], s[2]))


def house_before(text: str, at: int) -> int | None:
    """Where the house number begins that one to four capitalised words of any length part from ``at``."""
    for _ in range(NAMES):
        start = at
        while start and NAME.match(text, start - 1):
            start -= 1
        if start == at or not "A" <= text[start] <= "Z" or start < 2 or text[start - 1] != " ":
            return None
        at = start - 1
        if run := HOUSE.search(text, max(0, at - 7), at):  # six signs and the one before them
            return run.start()
    return None


def is_card(run: str) -> bool:
    """12 to 19 digits whose Luhn sum ends in 0."""
    digits = [int(c) for c in run if c.isdigit()]
    if not 12 <= len(digits) <= 19:
        return False
    total = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def is_account(value: str) -> bool:
    """6 to 30 digits, or an IBAN whose rest modulo 97 is 1."""
    plain = value.replace(" ", "").replace("-", "").upper()
    if plain.isdigit():
        return True
    return bool(IBAN.fullmatch(plain)) and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def redacted(text: str | None) -> str | None:
    """The text with every finding replaced by its kind; of overlapping ones the first stands."""
    if not text:
        return text
    parts, at = [], 0
    for kind, start, end in spans(text):
        if end <= at:
            continue
        if start >= at:
            parts += [text[at:start], f"<{kind.upper()}>"]
        at = end
    return "".join([*parts, text[at:]])


def joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in found)


SPANS = "array<struct<kind string, start int, end int>>"
DIGEST = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def _find(texts: pd.Series) -> pd.Series:
    return pd.Series([[{"kind": k, "start": s, "end": e} for k, s, e in spans(t)] for t in texts], dtype=object)


def _digest(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        found = spans(text)
        base = [s for s in found if s[0] in BASE]
        counts = [sum(s[0] == kind for s in base) for kind in BASE]
        rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(found)))
    return pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])


def _redact(texts: pd.Series) -> pd.Series:
    return pd.Series([redacted(t) for t in texts], dtype=object)


def personal_data(documents: DataFrame, text: str = "text", into: str = "pii_spans") -> DataFrame:
    """All columns and the spans as ``into``; a null or empty text has no spans, repeated rows are each read.

    A column of that name is refused, not replaced.
    """
    if into in documents.columns:
        raise ValueError(f"documents have a column {into!r}")
    return documents.withColumn(into, F.pandas_udf(_find, SPANS)(_whole(text)))


def without_personal_data(documents: DataFrame, text: str = "text") -> DataFrame:
    """The documents with findings replaced by their kind, same columns; null texts stay null."""
    return documents.withColumn(text, F.pandas_udf(_redact, "string")(F.col(text)))


def _whole(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def pii_digest(documents: DataFrame) -> DataFrame:
    """One row per document: counts and digest of the base kinds, and all spans as text.

    A null or empty text has no findings and the digest of nothing; repeated
    rows are read each, a null id stays null, texts of any length are read
    whole, an empty table gives no rows.  Only ``doc_id`` and ``text`` are read.
    """
    return documents.select("doc_id", F.pandas_udf(_digest, DIGEST)(_whole("text")).alias("d")).select("doc_id", "d.*")
