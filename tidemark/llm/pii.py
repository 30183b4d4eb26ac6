"""Personal data in texts: an Aho-Corasick automaton finds anchors, local parsers expand them.

Anchors are at-signs, plus signs before a digit, digits joined by a dot, a blank or a hyphen,
URL schemes and words that announce an identifier. From each anchor a parser walks left and
right over the characters its kind may hold, so the work is linear in the text. The spans of
the base kinds are the leftmost non-overlapping matches of these patterns, checked once:

* ``email``  ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
* ``ip``     four numbers joined by dots, each at most 255
* ``card``   digits with at most one blank or hyphen between two, 12 to 19, passing Luhn
* ``phone``  ``\\+[0-9][ ().0-9-]+[0-9]`` with 9 to 15 digits

Three kinds come on top, for what those patterns cannot hold:

* ``mail``     an address whose local part or domain has letters beyond ASCII, a quoted local
  part, or a domain given as an address in square brackets
* ``url``      a URL with a user name, or with a numeric host
* ``account``  after a cue, an IBAN with its check digits, a US social security number in a
  valid range, or an account number of 6 to 17 digits

Null text counts as empty, a null id keeps its row, equal rows each give one; no row is lost.
"""

from __future__ import annotations

import ipaddress
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, spread, texts

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "mail", "url", "account")

SCHEMES = ("http://", "https://", "ftp://", "ftps://", "sftp://", "ssh://", "ws://", "wss://")
CUES = {"iban": "iban", "ssn": "ssn", "social security": "ssn",      # cue -> what may follow
        **dict.fromkeys(("account", "acct", "a/c", "konto", "kontonummer", "compte", "cuenta"), "account")}

Span = tuple[int, int, str]

_DIGITS = re.compile(r"[0-9]++")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE_TAIL = re.compile(r"[ ().0-9-]++")
_WIDE_DOMAIN = re.compile(r"[^\W_](?:[\w-]*[^\W_])?(?:\.[^\W_](?:[\w-]*[^\W_])?)+")
_FILLER = re.compile(r"(?:[ \t]?(?:numbers?\b|nummer\b|numéro\b|número\b|no\b\.?|nr\b\.?|#|:|=|is\b)){0,3}[ \t]?", re.IGNORECASE)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?!000|666|9)[0-9]{3}([ -])(?!00)[0-9]{2}\1(?!0000)[0-9]{4}(?![0-9])")
_ACCOUNT = re.compile(r"[0-9](?:[ -]?[0-9]){5,16}(?![ -]?[0-9])(?![A-Za-z])")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_LONGEST_LOCAL, _LONGEST_DOMAIN, _LONGEST_AUTHORITY = 64, 253, 512


@cache
def _anchors():
    import ahocorasick

    found = ahocorasick.Automaton()

    def add(word: str, anchor: str, back: int) -> None:
        """``back`` leads from a pattern's last character to where its parser begins."""
        held = found.get(word, ())
        found.add_word(word, (*held, (anchor, back)))

    digits = "0123456789"
    add("@", "email", 0)
    for a in digits:
        add("+" + a, "phone", 1)
        for b in digits:
            add(f"{a}.{b}", "ip", 1)
            for gap in ("", " ", "-"):
                add(a + gap + b, "card", 1 + len(gap))
    for word, anchor in [*((w, "url") for w in SCHEMES), *CUES.items()]:
        for form in {word, word.upper(), word.capitalize(), word.title()}:
            add(form, anchor, -1)
    found.make_automaton()
    return found


def _email(text: str, at: int, least: int) -> tuple[int, int] | None:
    start = at
    while start > least and text[start - 1] in _LOCAL:
        start -= 1
    if start == at:
        return None
    domain = _DOMAIN.match(text, at + 1)
    return (start, domain.end()) if domain else None


def _ip(text: str, dot: int, least: int) -> tuple[int, int] | None:
    """Four digit runs from the one left of ``dot``, whatever their values."""
    start = dot
    while start > least and "0" <= text[start - 1] <= "9":
        start -= 1
    if start == dot:
        return None
    end = dot
    for _ in range(3):
        run = _DIGITS.match(text, end + 1) if text[end:end + 1] == "." else None
        if run is None:
            return None
        end = run.end()
    return start, end


def _small_parts(parts: list[str]) -> bool:
    return all(len(p) <= 3 and int(p) <= 255 for p in (p.lstrip("0") or "0" for p in parts))


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _phone(text: str, plus: int) -> tuple[int, int] | None:
    tail = _PHONE_TAIL.match(text, plus + 2)
    kept = tail.group().rstrip(" ().-") if tail else ""
    return (plus, plus + 2 + len(kept)) if len(kept) >= 2 else None


def _wide_mail(text: str, at: int, base: tuple[int, int] | None) -> tuple[int, int] | None:
    """An address around ``at`` that reaches further than the base pattern's match there."""
    start, least = at, max(0, at - _LONGEST_LOCAL)
    if text[at - 1:at] == '"':
        opening = text.rfind('"', least, at - 1)
        if opening < 0 or opening == at - 2 or "\n" in text[opening:at]:
            return None
        start = opening
    else:
        while start > least and (text[start - 1].isalnum() or text[start - 1] in "._%+-'"):
            start -= 1
        while start < at and not text[start].isalnum():
            start += 1
    if start == at:
        return None
    if text[at + 1:at + 2] == "[":
        close = text.find("]", at + 2, at + 50)
        if close < 0 or not _address(text[at + 2:close].removeprefix("IPv6:")):
            return None
        return start, close + 1
    domain = _WIDE_DOMAIN.match(text, at + 1, at + 2 + _LONGEST_DOMAIN)
    if domain is None:
        return None
    last = domain.group().rpartition(".")[2]
    if len(last) < 2 or not last.isalpha():
        return None
    found = start, domain.end()
    if base and base[0] <= found[0] and base[1] >= found[1]:
        return None
    plain = text[found[0]:found[1]].isascii() and text[at - 1] != '"'
    return None if plain else found


def _address(host: str) -> bool:
    try:
        ipaddress.ip_address(host)
    except ValueError:
        return False
    return True


def _url(text: str, after: int) -> tuple[int, int] | None:
    """The scheme, user and host of a URL that names a user or a numeric host."""
    end = after
    while end < len(text) and end - after < _LONGEST_AUTHORITY and not text[end].isspace() and text[end] not in "/?#\"'<>`,;":
        end += 1
    user, at, place = text[after:end].rpartition("@")
    place = place.rstrip(".)")
    end = after + len(user) + len(at) + len(place)
    host = place[1:place.find("]")] if place.startswith("[") and "]" in place else place.partition(":")[0]
    if not host or not (at and user.strip(":") or _address(host)):
        return None
    start = after - 3
    while start > 0 and after - start < 8 and text[start - 1].isalpha() and text[start - 1].isascii():
        start -= 1
    return start, end


def _iban(value: str) -> bool:
    packed = value.replace(" ", "")
    if not 15 <= len(packed) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in packed[4:] + packed[:4])) % 97 == 1


def _account(text: str, after: int, cue: str) -> tuple[int, int] | None:
    """The identifier after a cue; an IBAN may follow the word account as well."""
    if after < len(text) and text[after].isalnum():
        return None
    begin = _FILLER.match(text, after).end()
    iban = _IBAN.match(text, begin) if cue != "ssn" else None
    if iban:
        # the digits of what follows may stand after a blank as well: the longest valid one counts
        end = iban.end()
        while end > begin:
            if _iban(text[begin:end]):
                return begin, end
            end = text.rfind(" ", begin, end)
        return None
    found = {"ssn": _SSN, "account": _ACCOUNT}[cue].match(text, begin) if cue != "iban" else None
    return found.span() if found else None


def personal_spans(text: str) -> list[Span]:
    """All spans of ``text`` as (start, end, kind), by start, then in the order of ``KINDS``."""
    spans: list[Span] = []
    over = dict.fromkeys(KINDS, 0)          # where the last match of a kind ended, valid or not

    def put(kind: str, found: tuple[int, int] | None, valid: bool) -> None:
        if found:
            over[kind] = found[1]
            if valid:
                spans.append((*found, kind))

    for last, anchors in _anchors().iter(text):
        for anchor, back in anchors:
            at = last - back
            if anchor == "card":
                if at >= over["card"]:
                    end = _CHAIN.match(text, at).end()
                    digits = text[at:end].replace(" ", "").replace("-", "")
                    put("card", (at, end), 12 <= len(digits) <= 19 and _luhn(digits))
            elif anchor == "ip":
                if at >= over["ip"] and (found := _ip(text, at, over["ip"])):
                    put("ip", found, _small_parts(text[found[0]:found[1]].split(".")))
            elif anchor == "phone":
                if at >= over["phone"] and (found := _phone(text, at)):
                    put("phone", found, 9 <= sum("0" <= c <= "9" for c in text[found[0]:found[1]]) <= 15)
            elif anchor == "email":
                found = _email(text, at, over["email"]) if at >= over["email"] else None
                put("email", found, True)
                if at >= over["mail"]:
                    put("mail", _wide_mail(text, at, found), True)
            elif anchor == "url" and at >= over["url"]:
                put("url", _url(text, at), True)
            elif anchor in CUES.values() and at >= over["account"] and not _inside_word(text, at):
                put("account", _account(text, at, anchor), True)
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def _inside_word(text: str, after: int) -> bool:
    """Whether the cue that ends before ``after`` is only the end of a longer word."""
    start = max(0, after - 24)
    word = re.search(r"[\w/]+(?: security)?$", text[start:after], re.IGNORECASE)
    return word is None or word.group().lower() not in CUES


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and ``spans``, an array of (kind, start, end, base).

    Positions count code points, the end is exclusive. Extra columns are not read. An empty
    table gives no rows; a text without personal data gives an empty array.
    """
    ids = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
        for batch in batches:
            found = [[(k, s, e, k in BASE_KINDS) for s, e, k in personal_spans(text)] for text in texts(batch)]
            rows = [[{"kind": k, "start": s, "end": e, "base": b} for k, s, e, b in spans] for spans in found]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], ["doc_id", "spans"])

    return spread(id_text(docs, id_col, text_col)).mapInArrow(
        scan, f"doc_id {ids}, spans array<struct<kind: string, start: bigint, end: bigint, base: boolean>>")


def span_digests(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans as text."""
    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = joined(F.filter("spans", lambda s: s["base"]))
    return found.select("doc_id", *[count(k) for k in BASE_KINDS],
                        F.sha2(base.cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` with every span replaced by its kind in angle brackets.

    Overlapping spans become one, named after the first. Null text becomes empty.
    """
    ids = docs.schema[id_col].dataType.simpleString()

    def mask(text: str) -> str:
        out, done = [], 0
        for start, end, kind in personal_spans(text):
            if start >= done:
                out += [text[done:start], f"<{kind}>"]
            done = max(done, end)
        return "".join(out) + text[done:]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([mask(t) for t in texts(batch)], pa.string())], ["doc_id", "text"])

    return spread(id_text(docs, id_col, text_col)).mapInArrow(scan, f"doc_id {ids}, text string")
