"""Personal information in free text: a semi-Markov conditional random field over candidate segments.

Segments of bounded length that could be an email address, a phone number, an identity number, a street address or a
person's name are proposed with all their plausible boundaries. Whole-span features (shape, length, lexicon, the words on
either side) score each; a dynamic program over non-overlapping segments chooses boundaries and types together. The
weights are the maximum of the conditional likelihood on labelled text that a generator writes; surnames and towns, for
which no list is given, are counted over all documents.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import ship

TYPES = ("email", "phone", "id_number", "address", "person")
GIVEN_MOST = 100_000  # bound on the given names that every task holds
LEXICON_MOST = 1_000_000  # bound on the surnames and towns that every task holds (about 100 MB)

# ---------------------------------------------------------------- proposals

_MARKS = "̀-ͯऀ-ःऺ-ॏॕ-ॣ஀-ஂா-்ௗ"
_WORD = re.compile(rf"(?:[^\W\d_]|[{_MARKS}'’])+(?:-(?:[^\W\d_]|[{_MARKS}])+)*")
_ASCII = re.compile(r"[a-z]{3,}")
_PLAIN = re.compile(rf"(?:[^\W\d_]|[{_MARKS}])+")

_DOT = r"(?:\.|\s?[\[({]\s?(?:dot|punto|point|punkt)\s?[\])}]\s?|\s(?:dot|punto|point|punkt)\s)"
_AT_ANCHOR = re.compile(r"\s?[@＠]\s?|\s?[\[({]\s?(?:at|arroba|arobase|ät)\s?[\])}]\s?|\s(?:at|arroba|arobase)\s(?=[A-Za-z0-9-]+\s?(?:[\[({]\s?)?(?:dot|punto|point)\b)", re.I)
_SPELLED = ("at)", "at]", "at}", " dot ", " punto ", " point ", "[dot", "(dot", "arroba", "arobase", "ät")
_LOCAL = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9._+%-]{0,62}[A-Za-z0-9_+-])?$|[A-Za-z0-9]$")
_DOMAIN = re.compile(rf"[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)*{_DOT}[A-Za-z]{{2,18}}(?![A-Za-z0-9])", re.I)

_NUMBER = re.compile(r"\d[\d\s().\-/–]{5,22}\d(?![\w/:]|[.,-]\d)")
_BEFORE = re.compile(r"(?:(?<![\w.,/:+-])|^)(?:\+\s?|\(\+?)?$")
_FREE = re.compile(r"[^\w.,/:+-]$")
_DIGITS4 = re.compile(r"\d{4,9}")
_ALNUM = re.compile(r"[A-Z]{5}\d{4}[A-Z]|\d{7,9}-?[A-Z]|[A-Z]-?\d{7}-?[A-Z]|[A-Z]{1,2}\d{6,8}[A-Z]?")
_LEFT, _RIGHT = re.compile(r"(?:[A-Z]+-?)?$"), re.compile(r"(?:-?[A-Z])?(?![\w-])")
_INSURANCE = re.compile(r"(?<![\w-])[A-Z]{2} ?\d\d ?\d\d ?\d\d ?[A-D](?![\w-])")

_UNIT = r"(?:(?:Flat|Apt\.?|Apartment|Unit|Suite|Ste\.?|Room|House|Plot|Door|Block|Shop|Villa|Site)(?:\s(?:No\.?|Nr\.?|#))?|No\.?|Nr\.?|#)"
_TYPE_EN = r"(?:Street|St|Road|Rd|Lane|Ln|Avenue|Ave|Drive|Dr|Terrace|Ter|Close|Court|Ct|Way|Crescent|Cres|Square|Sq|Boulevard|Blvd|Place|Pl|Row|Walk|Hill|Gardens|Grove|Parade|Nagar|Salai|Marg|Layout|Colony)\b\.?"
_CAP = r"(?:[A-ZÀ-Þ][\w'’-]*)"
_ORD = r"(?:\d{1,3}(?:st|nd|rd|th)|First|Second|Third|Fourth|Fifth|Sixth|Seventh|Eighth|Ninth|Tenth)"
_SEP = r"(?:,\s\s?|,?[ \t]*\r?\n[ \t]*)"
_TOWN = rf"(?P<town>{_CAP}(?:\s(?:(?:de|del|la|le|les|sur|sous|am|an der|upon|on|of|the)\s)?{_CAP}){{0,2}})"
_ADDRESS = [
    re.compile(rf"(?<![\w/.-])(?:{_UNIT}\s?\d{{1,5}}[A-Za-z]?(?:/\d{{1,4}}[A-Za-z]?)?,?\s)?(?:{_UNIT}\s?)?\d{{1,5}}[A-Za-z]?(?:/\d{{1,4}}[A-Za-z]?)?,?\s(?:{_ORD}\s)?(?:{_CAP}\s){{1,3}}?{_TYPE_EN}{_SEP}{_TOWN}(?:,?\s\d{{5,6}}\b)?"),
    re.compile(rf"(?<![\w/.-]){_UNIT}\s?\d{{1,5}}[A-Za-z]?(?:/\d{{1,4}}[A-Za-z]?)?,\s(?:{_ORD}\s)?(?:{_CAP}\s){{1,3}}?{_TYPE_EN}{_SEP}{_TOWN}(?:,?\s\d{{5,6}}\b)?"),
    re.compile(rf"(?<![\w/.-])\d{{1,4}}(?:\s?(?:bis|ter|quater))?,?\s(?i:rue|avenue|boulevard|chemin|allée|place|quai|impasse|cours|route)\s(?i:(?:des|de la|de l['’]|du|de|d['’])\s?)?(?:{_CAP}\s?){{1,4}}{_SEP}\d{{5}}\s{_TOWN}"),
    re.compile(rf"(?<!\w)(?i:calle|c/|avenida|avda\.?|av\.|plaza|pza\.?|paseo|camino|carrer|ronda|travesía)\s?(?:(?:de|del|la|las|los|el)\s){{0,2}}(?:{_CAP}\s?){{1,4}},\s(?:n\.?º\s?)?\d{{1,4}}(?:\s?[A-Za-z]\b)?(?:,\s\d{{1,2}}[ºª.]?\s?[A-Za-z]?)?{_SEP}\d{{5}}\s{_TOWN}"),
    re.compile(rf"(?<!\w)(?:{_CAP}[ -])?[A-ZÄÖÜ][\w-]*(?i:straße|strasse|str\.|weg|gasse|allee|platz|ring|damm|ufer|steig|pfad|chaussee)\s\d{{1,4}}\s?[a-zA-Z]?{_SEP}(?:D-)?\d{{5}}\s{_TOWN}"),
]
_DIGITS = re.compile(r"\d+")
# a house number and a street behind it, in any case; or a postcode
_HOUSE = re.compile(r"(?i)\d{1,5}[a-z]?(?:/\d{1,4}[a-z]?)?,?\s(?:(?:\d{1,3}(?:st|nd|rd|th)|[a-z]+)\s)?(?:[^\W\d_][\w'’-]*\s){1,4}?(?:street|st|road|rd|lane|ln|avenue|ave|drive|dr|terrace|ter|close|court|ct|way|crescent|cres|square|sq|boulevard|blvd|place|pl|row|walk|hill|gardens|grove|parade|nagar|salai|marg|layout|colony)\b")
_POSTCODE = re.compile(r"\d{5}\s[^\W\d_]")
_LOWER_ADDRESS = [re.compile(p.pattern.replace(_CAP, r"(?:[^\W\d_][\w'’-]*)"), re.I) for p in _ADDRESS]


@dataclass
class Span:
    start: int
    end: int
    type: str
    features: tuple[str, ...] = ()


@dataclass
class Lexicon:
    given: frozenset[str] = frozenset()
    surnames: frozenset[str] = frozenset()
    towns: frozenset[str] = frozenset()
    given_heads: frozenset[str] = frozenset()
    given_tails: frozenset[str] = frozenset()
    surname_heads: frozenset[str] = frozenset()
    surname_tails: frozenset[str] = frozenset()
    known: dict[str, bool] = field(default_factory=dict, repr=False, compare=False)  # words met, and whether they look like names

    def givenlike(self, w: str) -> bool:
        return len(w) > 5 and w[:4] in self.given_heads and w[-3:] in self.given_tails

    def surnamelike(self, w: str) -> bool:
        return all(p in self.surnames or (len(p) > 6 and p[:4] in self.surname_heads and p[-4:] in self.surname_tails) for p in w.split("-"))


def _lexicon(given: list[str], surnames: list[str], towns: list[str]) -> Lexicon:
    def common(parts: Iterator[str]) -> frozenset[str]:
        return frozenset(x for x, n in Counter(parts).items() if n > 1)

    g, s = {x.lower() for x in given if x}, {x.lower() for x in surnames}
    return Lexicon(frozenset(g), frozenset(s), frozenset(t.lower() for t in towns), common(x[:4] for x in g), common(x[-3:] for x in g), common(x[:4] for x in s), common(x[-4:] for x in s))


# Words that announce a kind of information, or the number of something that is no person's
_CUES = {
    "phone": r"tel\b|phone|call|text|mobile|cell|fax|whatsapp|reach|number is|answers at|contact|erreichen|telefon|handy|rufnummer|anruf|tel[eé]fono|m[oó]vil|llam|t[eé]l[eé]phone|num[eé]ro est|portable|appel|தொலைபேசி|கைபேசி|அழை|फ़ोन|फोन|मोबाइल|नंबर",
    "id": r"social|ssn|aadhaa?r|\bpan\b|passport|passeport|pasaporte|reisepass|pass(?:nummer|-nr)|ausweis|personal(?:ausweis|-id)|\bdni\b|\bnie\b|\bnif\b|national id|identity|identi(?:dad|t[eé])|\bid (?:no|number|card)|driving licen|licen[cs]e no|voter|tax (?:id|no)|steuer|s[eé]curit[eé] sociale|insurance number|ஆதார்|பாஸ்போர்ட்|கடவுச்சீட்டு|आधार|पासपोर्ट|पैन",
    "other": r"order|ticket|part n|part number|invoice|receipt|serial|version|case|ref\b|reference|cost|total|price|tracking|build|sku|batch|item|isbn|account balance|bestell|rechnung|pedido|factura|commande|facture|checksum|amount|ஆர்டர்|ரசீது|रसीद|ऑर्डर",
    "address": r"address|live|moved to|ship|deliver|hangs at|located|visit|office|wohn|adresse|anschrift|vivo|direcci|domicil|habite|என் முகவரி|முகவரி|வீடு|पता|घर|रहत",
    "name": r"name is|named|i am|i'm|this is|ask for|contact|belongs to|reported by|signed|regards|sincerely|thanks,|dear|attn|name ist|ich bin|hei(?:ß|ss)e|me llamo|mi nombre|soy|m'appelle|mon nom|je suis|பெயர்|என் name|नाम|by|from|for",
    "email": r"mail|reach|contact|write|send|copy|login|schreib|escr[ií]b|[eé]criv|மின்னஞ்சல்|mail id|पता|ईमेल",
}
_CUE = {k: re.compile(rf"(?i)(?:{v})[^\n]{{0,24}}$") for k, v in _CUES.items()}
_EDITION = re.compile(r"(?i)^\s*(?:edition|version|left the|was closed|fits|in total)")


_TITLE = re.compile(r"(?i)(?<!\w)(?:mr|mrs|ms|miss|dr|prof|sir|sr|sra|srta|don|doña|herr|frau|monsieur|madame|mme|mlle|m|shri|smt|திரு|திருமதி|श्री|श्रीमती)\.?\s$")


def _edges(text: str, a: int, b: int, names: tuple[str, ...]) -> list[str]:
    left = text[max(0, a - 44) : a]
    left = left[left.rfind("\n") + 1 :]
    out = [f"l:{n}" for n in names if _CUE[n].search(left)]
    right = text[b : b + 16]
    if _TITLE.search(left):
        out.append("l:title")
    if _EDITION.match(right):
        out.append("r:edition")
    c = right.lstrip(" \t\xa0")[:1]
    out.append("r:end" if not c or c in "\r\n.,;|·)!?" else "r:text")
    c = left.rstrip(" \t\xa0")[-1:]
    out.append("l:start" if not c or c in "|·-:>" else "l:text")
    return out


def _emails(text: str, low: str) -> Iterator[Span]:
    if "@" not in text and "＠" not in text and not any(x in low for x in _SPELLED):
        return
    for m in _AT_ANCHOR.finditer(text):
        local = _LOCAL.search(text[max(0, m.start() - 66) : m.start()])
        domain = _DOMAIN.match(text, m.end(), min(len(text), m.end() + 120))
        if local and domain:
            a, b = m.start() - len(local[0]), domain.end()
            anchor = m[0].strip().lower()
            how = "plain" if anchor in "@＠" and len(anchor) == 1 else "spelled" if anchor[0].isalpha() else "bracket"
            # a spelled-out address may be read too far: shorter domains are proposals as well
            yield Span(a, b, "email", ("email", f"how:{how}", *_edges(text, a, b, ("email",))))


def _groups(s: str) -> str:
    return "-".join(str(len(g)) for g in re.findall(r"\d+", s))


def _numbers(text: str) -> Iterator[Span]:
    for m in _NUMBER.finditer(text):
        head = text[max(0, m.start() - 3) : m.start()]
        lead = _BEFORE.search(head) if head[-1:] in "+( " or not head else None
        if head and lead is None and not _FREE.search(head):
            continue
        raw = (lead[0] if lead else "") + m[0]
        spans = [raw]
        if re.search(r"\s{2,}|\n", raw):  # never across wide gaps or lines
            spans = [p for p in re.split(r"\s{2,}|\n", raw) if p]
        at = m.end() - len(raw)
        for s in spans:
            at = text.index(s, at)
            a = at
            s2 = s.strip(" -.–/")
            if s2.count("(") < s2.count(")"):
                s2 = s2.strip(") ")
            if s2.count("(") > s2.count(")") and s2[0] == "(":
                a += 1
                s2 = s2[1:]
            a += s.index(s2) if a == at else 0
            digits = sum(c.isdigit() for c in s2)
            if not 7 <= digits <= 15:
                continue
            if re.fullmatch(r"\d{4}[-/.]\d\d[-/.]\d\d", s2) or re.fullmatch(r"\d\d?[-/.]\d\d?[-/.]\d{4}", s2) or re.match(r"\d{4}-\d\d-\d\d[ T]", text[a : a + 12]):
                continue
            b = a + len(s2)
            g = _groups(s2)
            lead = "+" if s2[0] == "+" else "(" if s2[0] == "(" else "00" if re.match(r"00[1-9]", s2) else "000" if s2.startswith("00") else "0" if s2[0] == "0" else "d"
            shape = [f"shape:{g}", f"lead:{lead}", f"digits:{digits}", "grouped" if "-" in g else "solid", "paren" if "(" in s2 else "flat", "quad" if re.fullmatch(r"\d{1,3}(?:\.\d{1,3}){3}", s2) else "dotted" if "." in s2 else "undotted"]
            edges = _edges(text, a, b, ("phone", "id", "other"))
            cue = "+".join(x for x in edges if x in ("l:phone", "l:id", "l:other"))
            yield Span(a, b, "phone", ("phone", *(f"p{x}" for x in shape), *(f"p{x}" for x in edges), f"pcue:{cue}", f"p{cue}&{g}"))
            if g in ("3-2-4", "4-4-4", "9", "12", "8", "10", "11", "2-3-3-3", "3-3-3", "1-2-2-2-3-3-2", "1-2-2-2-3-3"):
                yield Span(a, b, "id_number", ("id", *(f"i{x}" for x in shape), *(f"i{x}" for x in edges), f"icue:{cue}", f"i{cue}&{g}"))
    for m in _DIGITS4.finditer(text):
        right = _RIGHT.match(text, m.end())
        if right is None:
            continue
        left = _LEFT.search(text, max(0, m.start() - 7), m.start())
        a, b = left.start(), right.end()
        if (a and (text[a - 1].isalnum() or text[a - 1] in "-_")) or b - a == m.end() - m.start() or not _ALNUM.fullmatch(text, a, b):
            continue
        yield _coded(text, a, b)
    if "nsurance" in text:
        for m in _INSURANCE.finditer(text):
            yield _coded(text, m.start(), m.end())


def _coded(text: str, a: int, b: int) -> Span:
    kind = re.sub(r"\d", "9", re.sub(r"[A-Z]", "A", text[a:b]))
    edges = _edges(text, a, b, ("id", "other"))
    cue = "+".join(x for x in edges if x in ("l:id", "l:other"))
    return Span(a, b, "id_number", ("id", f"i{kind}", *(f"i{x}" for x in edges), f"icue:{cue}", f"i{cue}&{kind}"))


def _windows(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of the text that could hold an address."""
    a = b = -1
    for m in _DIGITS.finditer(text):
        n = m.end() - m.start()
        if m.start() and text[m.start() - 1].isalnum():
            continue  # the number of a code
        if n <= 5 and (_HOUSE.match(text, m.start()) or (n == 5 and _POSTCODE.match(text, m.start()))):
            lo, hi = m.start() - 110, m.start() + 160
            if lo > b:
                if b > 0:
                    yield a, b
                a = max(0, lo)
            b = min(len(text), hi)
    if b > 0:
        yield a, b


def _addresses(text: str, lex: Lexicon) -> Iterator[Span]:
    for lo, hi in _windows(text):
        yield from _addresses_in(text, lo, hi, lex)


def _addresses_in(text: str, lo: int, hi: int, lex: Lexicon) -> Iterator[Span]:
    """Addresses as they are written, and in any case where none of the first kind lies."""
    seen: set[tuple[int, int]] = set()
    taken: list[tuple[int, int]] = []
    for strict, patterns in ((True, _ADDRESS), (False, _LOWER_ADDRESS)):
        firm = list(taken)
        for k, p in enumerate(patterns):
            for m in p.finditer(text, lo, hi):
                if "\n\n" in m[0] or any(m.start() < e and b < m.end() for b, e in firm):
                    continue
                taken.append(m.span())
                town, t0 = m["town"], m.start("town")
                words = list(_WORD.finditer(town))
                for n in range(1, len(words) + 1):
                    b = t0 + words[n - 1].end()
                    name = re.sub(r"\s+", " ", text[t0:b])
                    if (m.start(), b) in seen:
                        continue
                    seen.add((m.start(), b))
                    known = name.lower() in lex.towns
                    over = any(re.sub(r"\s+", " ", text[t0 : t0 + w.end()]).lower() in lex.towns for w in words[: n - 1])
                    longer = any(re.sub(r"\s+", " ", text[t0 : t0 + w.end()]).lower() in lex.towns for w in words[n:])
                    f = ["address", f"style:{k}", "strict" if strict else "loose", f"town:{n}", "town:known" if known else "town:new", *(["town:cut"] if longer else []), *(["town:over"] if over else []), *(["town:exact"] if known and not longer else []), *(f"a{x}" for x in _edges(text, m.start(), b, ("address", "other")))]
                    nxt = text[b : b + 2]
                    f.append("next:word" if len(nxt) == 2 and nxt[0] == " " and nxt[1].isalpha() else "next:stop")
                    yield Span(m.start(), b, "address", tuple(f))


def _case(words: list[str]) -> str:
    kinds = {"U" if w.isupper() and len(w) > 1 else "C" if w[:1].isupper() else "l" if w.islower() else "n" for w in words}
    return "".join(sorted(kinds))


def _persons(text: str, low: str, lex: Lexicon) -> Iterator[Span]:
    known = lex.known
    hits = set()
    for w in set((_ASCII if low.isascii() else _PLAIN).findall(low)):
        k = known.get(w)
        if k is None:
            if len(known) > 500_000:
                known.clear()
            k = known[w] = w in lex.given or w in lex.surnames or lex.givenlike(w) or (len(w) > 6 and lex.surnamelike(w))
        if k:
            hits.add(w)
    cued = any(x in low for x in _NAME_CUES) and _NAME_CUE.search(text)
    if not hits and not cued:
        return
    toks = list(_WORD.finditer(text))
    lows = [t[0].lower().strip("'’") for t in toks]
    near: set[int] = set()
    for i, w in enumerate(lows):
        if w in hits or ("-" in w and any(p in hits for p in w.split("-"))):
            near.update((i - 2, i - 1, i, i + 1))
    if cued:
        ends = {m.end() for m in _NAME_CUE.finditer(text)}
        starts = {t.start(): i for i, t in enumerate(toks)}
        for e in ends:
            while e < len(text) and text[e] in " \t\xa0":
                e += 1
            if e in starts:
                near.add(starts[e])
    done: set[tuple[int, int]] = set()
    for i in sorted(near):
        if not 0 <= i < len(toks) - 1:
            continue
        for n in (2, 3):
            if i + n > len(toks):
                continue
            part = toks[i : i + n]
            gaps = [text[part[k].end() : part[k + 1].start()] for k in range(n - 1)]
            comma = n >= 2 and re.fullmatch(r",[ \xa0]", gaps[0]) is not None
            rest_ok = all(re.fullmatch(r"[ \xa0]|\.[ \xa0]", g) for g in gaps[1 if comma else 0 :])
            if not rest_ok or "\n" in "".join(gaps):
                continue
            initial = [k for k in range(n) if len(part[k][0]) == 1 and (part[k][0].isupper() or not part[k][0].isascii())]
            if any(g[0] == "." and k not in initial for k, g in enumerate(gaps)):
                continue
            full = [k for k in range(n) if k not in initial]
            if len(full) < 2:
                continue
            if n == 3 and not initial and not comma and lows[i + 2] not in hits:
                continue
            a, b = part[0].start(), part[-1].end()
            if n - 1 in initial and text[b : b + 1] == "." and comma:
                b += 1
            if (a, b) in done:
                continue
            done.add((a, b))
            first, last = (lows[i + full[-1]], lows[i]) if comma else (lows[i], lows[i + full[-1]])
            gk = "list" if first in lex.given else "like" if lex.givenlike(first) else "new"
            sk = "list" if all(p in lex.surnames for p in last.split("-")) else "like" if lex.surnamelike(last) else "given" if last in lex.given else "new"
            if gk == "new" and sk == "new" and not _NAME_CUE_END.search(text[max(0, a - 40) : a]):
                continue
            f = ["person", f"g:{gk}", f"s:{sk}", f"gs:{gk}{sk}", f"case:{_case([part[k][0] for k in full])}", f"n:{n}", "comma" if comma else "order", "initial" if initial else "noinitial", *(f"n{x}" for x in _edges(text, a, b, ("name", "other")))]
            if any(part[k][0].lower() in _NO_NAME for k in full):
                f.append("stopword")
            if len({("T" if "஀" <= part[k][0][0] <= "௿" else "L") for k in full}) > 1:
                f.append("scripts")
            yield Span(a, b, "person", tuple(f))


# phrases after which a name is expected
_NAME_CUES = ("my name is", "mein name ist", "me llamo", "mi nombre es", "je m'appelle", "je m’appelle", "mon nom est", "என் பெயர்", "என் name", "मेरा नाम", "this is", "ask for", "belongs to", "reported by", "best regards,", "kind regards,")
_NAME_CUE = re.compile(rf"(?i:{'|'.join(_NAME_CUES)})\s")
_NAME_CUE_END = re.compile(_NAME_CUE.pattern + r"*$")
# words that are no part of a name
_NO_NAME = frozenset("the a an and or of in on at to for from by with is was are please user assistant you i we it at the desk team inbox street road lane board plan then open after before first next last week my your our order ticket form login என் எனது எங்கள் मेरा मेरी मेरे हूँ है में का ஆகும் தான் und der die das el la los le les des et y mail".split())


def propose(text: str, lex: Lexicon) -> list[Span]:
    """All candidate segments of a text, by start; segments of different types and boundaries may overlap."""
    low = text.lower()
    out = [*_emails(text, low), *_numbers(text), *_addresses(text, lex), *_persons(text, low, lex)]
    out.sort(key=lambda s: (s.start, s.end))
    return out


# ---------------------------------------------------------------- the field

NEAR = 8  # characters between two segments that still see each other


def clusters(spans: list[Span]) -> Iterator[list[Span]]:
    """Groups of segments that overlap or stand within NEAR of each other; the field factorises over them."""
    group: list[Span] = []
    upto = -1
    for s in spans:
        if group and s.start > upto + NEAR:
            yield group
            group = []
            upto = -1
        group.append(s)
        upto = max(upto, s.end)
    if group:
        yield group


@dataclass
class Field:
    weights: dict[str, float] = field(default_factory=dict)

    def score(self, s: Span) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for f in s.features)

    def link(self, a: Span, b: Span) -> str | None:
        return f"t:{a.type}>{b.type}" if b.start - a.end <= NEAR else None

    def best(self, group: list[Span]) -> list[Span]:
        """The highest-scoring set of segments without overlap.

        Segments are taken by their end. Of those that end before NEAR characters in front of a segment only the best
        counts, which a running maximum knows; the few that end within NEAR are looked at one by one.
        """
        order = sorted(group, key=lambda s: (s.end, s.start))
        ends = [s.end for s in order]
        top: list[tuple[float, int]] = []  # value of the best chain that ends with a segment, and the segment before it (-1: none)
        upto: list[int] = []  # the best chain's last segment among those up to here
        for k, s in enumerate(order):
            lo, hi = bisect_left(ends, s.start - NEAR, 0, k), bisect_right(ends, s.start, 0, k)
            value, before = 0.0, -1
            if lo and top[upto[lo - 1]][0] > value:
                value, before = top[upto[lo - 1]][0], upto[lo - 1]
            for j in range(lo, hi):
                v = top[j][0] + self.weights.get(self.link(order[j], s) or "", 0.0)
                if v > value:
                    value, before = v, j
            top.append((value + self.score(s), before))
            upto.append(k if not upto or top[k][0] > top[upto[-1]][0] else upto[-1])
        at = upto[-1]
        if top[at][0] <= 0:
            return []
        out = []
        while at >= 0:
            out.append(order[at])
            at = top[at][1]
        return out[::-1]

    def gradient(self, group: list[Span], gold: set[tuple[int, int, str]]) -> dict[str, float]:
        """Of the log-likelihood of the gold segmentation: its features minus their expectation, by forward and backward sums."""
        n = len(group)
        order = sorted(range(n), key=lambda k: (group[k].start, group[k].end))
        g = [group[k] for k in order]
        sc = [self.score(s) for s in g]

        def logsum(xs: list[float]) -> float:
            m = max(xs)
            return m + math.log(sum(math.exp(x - m) for x in xs))

        def w(i: int, j: int) -> float:
            name = self.link(g[i], g[j])
            return self.weights.get(name, 0.0) if name else 0.0

        fwd, bwd = [0.0] * n, [0.0] * n
        for j in sorted(range(n), key=lambda k: g[k].end):
            fwd[j] = sc[j] + logsum([0.0, *(fwd[i] + w(i, j) for i in range(n) if g[i].end <= g[j].start)])
        for i in sorted(range(n), key=lambda k: -g[k].start):
            bwd[i] = logsum([0.0, *(sc[j] + w(i, j) + bwd[j] for j in range(n) if g[i].end <= g[j].start)])
        z = logsum([0.0, *fwd])  # every segmentation once, by its last segment
        out: dict[str, float] = {}
        truth = [i for i in range(n) if (g[i].start, g[i].end, g[i].type) in gold]
        for i in range(n):
            d = (i in truth) - math.exp(fwd[i] + bwd[i] - z)
            for f in g[i].features:
                out[f] = out.get(f, 0.0) + d
            for j in range(n):
                if g[i].end <= g[j].start and (name := self.link(g[i], g[j])):
                    out[name] = out.get(name, 0.0) - math.exp(fwd[i] + w(i, j) + sc[j] + bwd[j] - z)
        for i, j in zip(truth, truth[1:], strict=False):
            if name := self.link(g[i], g[j]):
                out[name] = out.get(name, 0.0) + 1.0
        return out

    def fit(self, data: list[tuple[list[Span], set[tuple[int, int, str]]]], epochs: int = 6, rate: float = 0.3, l2: float = 7e-4, seed: int = 3) -> Field:
        sums: dict[str, float] = {}
        rng = random.Random(seed)
        for _ in range(epochs):
            rng.shuffle(data)
            for group, gold in data:
                for f, d in self.gradient(group, gold).items():
                    d -= l2 * self.weights.get(f, 0.0)
                    if d:
                        sums[f] = sums.get(f, 0.0) + d * d
                        self.weights[f] = self.weights.get(f, 0.0) + rate * d / math.sqrt(1.0 + sums[f])
        return self


# ---------------------------------------------------------------- labelled text


class Writer:
    """Writes text with known personal information in it, in several languages, and look-alikes that are none."""

    def __init__(self, lex: Lexicon, seed: int = 11):
        self.r = random.Random(seed)
        self.lex = lex
        self.given = sorted(lex.given) or ["anna", "ravi"]
        self.surnames = sorted(lex.surnames)
        self.towns = sorted(lex.towns)

    def syllables(self, n: int = 3) -> str:
        return "".join(self.r.choice("bdfgklmnprstv") + self.r.choice("aeiou") + self.r.choice(["", "n", "l", "r", "s"]) for _ in range(n)).capitalize()

    def digits(self, n: int) -> str:
        return "".join(self.r.choice("0123456789") for _ in range(n))

    def cased(self, s: str) -> str:
        x = self.r.random()
        return s.upper() if x < 0.07 else s.lower() if x < 0.14 else s

    def name(self) -> str:
        # listed, put together from listed parts, or never seen
        mix = lambda heads, tails: self.r.choice(sorted(heads)) + self.r.choice(sorted(tails)) if heads and tails else self.syllables()
        x, y = self.r.random(), self.r.random()
        g = self.r.choice(self.given) if x < 0.6 else mix(self.lex.given_heads, self.lex.given_tails).lower() if x < 0.85 else self.syllables(2).lower()
        s = self.r.choice(self.surnames) if self.surnames and y < 0.55 else mix(self.lex.surname_heads, self.lex.surname_tails).lower() if y < 0.9 else self.syllables().lower()
        g, s = g.capitalize(), s.capitalize()
        if self.r.random() < 0.12:
            s += "-" + (self.r.choice(self.surnames).capitalize() if self.surnames else self.syllables())
        x = self.r.random()
        if x < 0.15:
            return self.cased(f"{s}, {g}")
        if x < 0.27:
            return f"{g} {self.r.choice('ABCDEFGHKLMRST')}. {s}"
        return self.cased(f"{g} {s}")

    def email(self) -> str:
        local = self.r.choice(["{a}.{b}", "{a}_{b}", "{a}{n}", "{a}-{b}", "{b}+{c}"]).format(a=self.syllables(2).lower(), b=self.syllables(2).lower(), c="shop", n=self.r.randint(1, 99))
        labels = [self.syllables(2).lower() for _ in range(self.r.choice([1, 1, 2]))] + [self.r.choice(["example", "test", "org", "com", "invalid"])]
        at, dot = self.r.choice([("@", ".")] * 4 + [(" (at) ", "."), ("[at]", "[dot]"), (" at ", " dot "), (" @ ", ".")])
        return self.cased(local + at + dot.join(labels)) if at == "@" else local + at + dot.join(labels)

    def phone(self) -> str:
        d = self.digits
        return self.r.choice([
            lambda: f"+1 {d(3)}-{d(3)}-{d(4)}", lambda: f"({d(3)}) {d(3)}-{d(4)}", lambda: f"+44 {d(4)} {d(6)}", lambda: f"0{d(4)} {d(5)}", lambda: f"+91 {d(5)} {d(5)}",
            lambda: f"+91-{d(5)}-{d(5)}", lambda: f"{d(3)}.{d(3)}.{d(4)}", lambda: f"555 {d(4)}", lambda: f"00{d(2)}-{d(2)}-{d(5)}-{d(3)}", lambda: f"1-{d(3)}-{d(3)}-{d(4)}",
            lambda: f"0{d(4)}-{d(3)}-{d(3)}", lambda: f"0{d(1)} {d(2)} {d(2)} {d(2)} {d(2)}", lambda: f"+33 {d(1)} {d(2)} {d(2)} {d(2)} {d(2)}", lambda: f"+49 {d(2)} {d(8)}", lambda: f"({d(3)}) {d(4)} {d(4)}",
            lambda: f"00{d(2)} {d(4)} {d(4)}", lambda: f"+1 ({d(3)}) {d(3)} {d(4)}", lambda: f"0{d(4)} {d(3)} {d(3)}", lambda: f"+{d(2)} {d(9)}", lambda: d(10),
        ])()

    def id_number(self) -> tuple[str, str]:
        d, u = self.digits, lambda n: "".join(self.r.choice("ABCDEFGHJKLMNPQRSTVWXYZ") for _ in range(n))
        return self.r.choice([
            lambda: (self.r.choice(["SSN ", "My social security number is ", "The form asks for the social ("]), f"{d(3)}{(s := self.r.choice('- '))}{d(2)}{s}{d(4)}"),
            lambda: (self.r.choice(["Aadhaar ", "My Aadhaar number is ", "ஆதார் எண் ", "मेरा आधार नंबर "]), f"{d(4)} {d(4)} {d(4)}"),
            lambda: (self.r.choice(["PAN: ", "PAN ", "my PAN is "]), f"{u(5)}{d(4)}{u(1)}"), lambda: (self.r.choice(["DNI ", "Mi DNI es "]), f"{d(8)}-{u(1)}"),
            lambda: (self.r.choice(["Passport no. ", "Reisepass ", "passport ", "Passeport ", "Pasaporte "]), f"{u(1)}{d(7)}"), lambda: ("National insurance number ", f"{u(2)}{d(6)}{u(1)}"),
            lambda: ("Personalausweis ", f"{u(2)}{d(7)}"), lambda: (self.r.choice(["Tax ID ", "Steuer-ID "]), d(11)),
        ])()

    def address(self) -> str:
        t = self.r.choice(self.towns).title() if self.towns and self.r.random() < 0.8 else self.syllables() + (f" {self.syllables(2)}" if self.r.random() < 0.3 else "")
        s, d = self.syllables(), self.r.randint
        kind = self.r.choice(["Street", "St.", "Road", "Rd", "Lane", "Avenue", "Drive", "Terrace", "Close"])
        unit = self.r.choice(["", "", "", f"Flat {d(1, 30)}B, ", f"Apt {d(1, 30)}A, ", f"Unit {d(1, 30)}C, "])
        return self.r.choice([
            f"{unit}{d(1, 250)}{self.r.choice(['', '', 'B'])} {s} {kind}{self.r.choice([', ', ', ', chr(10)])}{t}",
            f"{self.r.choice(['Plot', 'Door No.', 'No.'])} {d(1, 90)}/{d(1, 40)}, {self.r.choice(['4th', '9th', 'Second', 'Third'])} {s} Cross Street, {t}",
            f"{d(1, 200)}{self.r.choice(['', ' bis', ','])} rue des {s}, {self.digits(5)} {t}", f"{self.r.choice(['Calle', 'C/', 'Avenida'])} {s}, {d(1, 200)}, {self.digits(5)} {t}",
            f"{s}{self.r.choice(['weg', 'straße', 'gasse'])} {d(1, 200)}{self.r.choice(['', 'a'])}, {self.digits(5)} {t}",
        ])

    def line(self) -> tuple[str, list[tuple[str, str]]]:
        """A line and its (type, text) segments in order."""
        r = self.r
        x = r.random()
        if x < 0.2:
            n = self.name()
            pre, post = r.choice([("My name is ", "."), ("Please ask for ", " at the desk."), ("The account belongs to ", "."), ("This was reported by ", " last week."), ("Mein Name ist ", "."), ("Me llamo ", "."), ("Je m'appelle ", "."), ("என் பெயர் ", "."), ("मेरा नाम ", " है।"), ("", ""), ("- ", ""), ("", " signed the form."), ("என் name ", "."), (r.choice(["Mr. ", "Ms. ", "Dr. ", "Herr ", "Sra. "]), " signed the form.")])
            return f"{pre}{n}{post}", [("person", n)]
        if x < 0.34:
            n = self.email()
            pre, post = r.choice([("Send the file to ", " please."), ("You can reach me at ", "."), ("The old login was ", ", it no longer works."), ("contact: ", ""), ("Bitte schreiben Sie an ", " zurück."), ("Escríbame a ", " por favor."), ("என் மின்னஞ்சல் ", " ஆகும்."), ("मेरा पता ", " है।"), ("", ""), ("Copy ", " on the reply.")])
            return f"{pre}{n}{post}", [("email", n)]
        if x < 0.5:
            n = self.phone()
            pre, post = r.choice([("Call me on ", " after lunch."), ("My number is ", "."), ("The driver answers at ", ", mostly."), ("Text ", " when it is ready."), ("tel ", ""), ("Sie erreichen mich unter ", "."), ("Mi teléfono es ", "."), ("Mon numéro est le ", "."), ("என் தொலைபேசி எண் ", " ஆகும்."), ("मेरा फ़ोन नंबर ", " है।"), ("", "")])
            return f"{pre}{n}{post}", [("phone", n)]
        if x < 0.6:
            pre, n = self.id_number()
            return f"{pre}{n}{r.choice(['.', '', ')' if pre.endswith('(') else '', ' ' + self.plain()])}", [("id_number", n)]
        if x < 0.72:
            n = self.address()
            pre, post = r.choice([("We moved to ", " in spring."), ("Please ship it to ", "."), ("The meter hangs at ", "."), ("Address: ", ""), ("Address: ", " " + self.plain()), ("Vivo en ", "."), ("J'habite au ", "."), ("Ich wohne in ", "."), ("என் முகவரி ", " தான்."), ("मेरा घर ", " में है।"), ("", "")])
            return f"{pre}{n}{post}", [("address", n)]
        if x < 0.8:
            parts = [("person", self.name())] + r.sample([("email", self.email()), ("phone", self.phone()), ("address", self.address())], r.randint(1, 3))
            return r.choice(["  ·  ", " | "]).join(t for _, t in parts), parts
        return self.plain(), []

    def plain(self) -> str:
        r, d = self.r, self.digits
        word = (r.choice(self.given) if r.random() < 0.5 else r.choice(self.surnames) if self.surnames else "kelo").lower()
        return r.choice([
            f"The order {d(4)} {d(4)} {d(4)} left the warehouse.", f"Ticket {d(3)}-{d(2)}-{d(4)} was closed.", f"Part number {d(5)}-{d(5)} fits the Granite Street edition.", f"It cost {d(2)},{d(3)}.{d(2)} in total on 2031-12-17.",
            f"Version {d(1)}.{d(1)}.{d(2)}.{d(3)} is stable.", f"The node {r.randint(1, 255)}.{r.randint(0, 255)}.{r.randint(0, 99)}.{r.randint(1, 255)} answered in {d(3)} ms.", f"Room {d(2)} on Level {d(1)} is booked at noon.", f"Invoice {d(8)} was paid, receipt {d(4)}-{d(4)}.", f"Follow @{word} for news.", 'Use "user@" as the prefix of the rule.', "See section 12 Main Menu, Second Column.",
            "Open Payment History, then Team Inbox.", f"A clerk painted the {word} gate in {d(2)} stripes.", f"The {word} handbook and the {word} ledger", f"Serial {d(10)} and case {d(3)}.{d(3)}.{d(4)}", f"Every midnight the phone freezes while {word} runs.",
            f"{r.choice(['My', 'The', 'Someone on', 'Readers of', 'Most questions'])} team lost 13 drafts at 10 in the morning.", f"Reference {d(2)}{d(5)} and code Q-{d(4)}.", f"The {d(2)} lines of {word.capitalize()} Street are new.", f"User: {self.syllables(2)} {self.syllables(2)} is open.",
        ])


def labelled_text(lex: Lexicon, lines: int = 5000, seed: int = 11) -> list[tuple[list[Span], set[tuple[int, int, str]]]]:
    """Clusters of proposed segments with the true ones, from ``lines`` written lines."""
    w = Writer(lex, seed)
    out = []
    for _ in range(lines):
        text, parts = w.line()
        before = w.plain() + w.r.choice(["\n", " ", "\n\n"]) if w.r.random() < 0.4 else ""
        full, at, gold = before + text, len(before), set()
        for kind, t in parts:
            a = full.index(t, at)
            gold.add((a, a + len(t), kind))
            at = a + len(t)
        out += [(g, gold) for g in clusters(propose(full, lex))]
    return out


# ---------------------------------------------------------------- model and operators


@dataclass
class Model:
    lex: Lexicon
    field: Field

    def find(self, text: str) -> list[Span]:
        out: list[Span] = []
        for g in clusters(propose(text, self.lex)):
            out += self.field.best(g)
        return out


_FIRM_END = re.compile(r"\s*(?:$|[\n\r.|·;)]|தான்|ஆகும்|में|in spring)")


def _beside(t: str, names: frozenset[str], first: frozenset[str]) -> Iterator[tuple[str, str]]:
    """(surname or town, lower-case text) for every word beside a given name and every end of an address that stops firmly."""
    if not first.isdisjoint(_PLAIN.findall(t.lower())):
        toks = list(_WORD.finditer(t))
        for i, m in enumerate(toks):
            if m[0].lower() in names and (m[0][0].isupper() or not m[0][0].isascii()):
                if i + 1 < len(toks):
                    gap, nxt = t[m.end() : toks[i + 1].start()], toks[i + 1]
                    if re.fullmatch(r"[A-Z]", nxt[0]) and t[nxt.end() : nxt.end() + 2] == ". " and i + 2 < len(toks):
                        nxt, gap = toks[i + 2], " "
                    if gap in (" ", "\xa0") and (nxt[0][0].isupper() or (not nxt[0][0].isascii() and not m[0][0].isascii())) and len(nxt[0]) > 3:
                        yield from (("surname", p.lower()) for p in nxt[0].split("-"))
                if i and t[toks[i - 1].end() : m.start()] == ", " and toks[i - 1][0][0].isupper() and len(toks[i - 1][0]) > 3:
                    yield from (("surname", p.lower()) for p in toks[i - 1][0].split("-"))
    for lo, hi in _windows(t):
        for p in _ADDRESS:
            for m in p.finditer(t, lo, hi):
                if _FIRM_END.match(t, m.end("town")):
                    yield "town", re.sub(r"\s+", " ", m["town"]).lower()


def _names(given: list[str]) -> tuple[frozenset[str], frozenset[str]]:
    """The given names in lower case, and the first letters of each up to a mark, one of which a text must hold."""
    names = frozenset(g.lower() for g in given if g)
    return names, frozenset(m[0] for m in map(_PLAIN.search, names) if m)


def _seen_twice(given: list[str], counts: Iterator[tuple[str, str, int]]) -> Lexicon:
    empty = _lexicon(given, [], [])
    seen = sorted((k, w) for k, w, n in counts if n > 1)
    return _lexicon(given, [w for k, w in seen if k == "surname" and w not in empty.given and w not in _NO_NAME], [w for k, w in seen if k == "town"])


def learn(texts: list[str], given: list[str]) -> Lexicon:
    """Lexicon of the given names with surnames (words beside them, seen twice) and towns (ends of addresses that stop firmly, seen twice)."""
    counts = Counter(x for t in texts for x in _beside(t, *_names(given)))
    return _seen_twice(given, ((k, w, n) for (k, w), n in counts.items()))


def train(texts: list[str], given: list[str]) -> Model:
    lex = learn(texts, given)
    return Model(lex, Field().fit(labelled_text(lex)))


def _counter(given: list[str]):
    names, first = _names(given)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple[str, str]] = Counter()

        def out() -> pa.RecordBatch:
            kinds, found = zip(*counts, strict=True) if counts else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(found, pa.string()), pa.array(list(counts.values()), pa.int64())], ["kind", "found", "n"])

        for b in batches:
            for t in b.column(0).to_pylist():
                counts.update(_beside(t, names, first))
            if len(counts) > 100_000:
                yield out()
                counts.clear()
        yield out()

    return run


_fields: dict[tuple, Field] = {}  # the last fields of this process, by the lexicon that their text was written with


def fit(documents: DataFrame, known_names: DataFrame, most: int = LEXICON_MOST) -> Model:
    """Model from all documents and the table of given names, which is small by nature.

    Surnames and towns are counted over every document; a lexicon of more than ``most`` entries is refused, not cut.
    """
    ship(documents.sparkSession)
    given = sorted(r[0] for r in known_names.select("given_name").dropna().distinct().limit(GIVEN_MOST + 1).collect())
    if len(given) > GIVEN_MOST:
        raise ValueError(f"more than {GIVEN_MOST} given names: too many to send to every task")
    found = documents.filter("text <> ''").select(F.col("text").cast("string")).mapInArrow(_counter(given), "kind string, found string, n long")
    rows = found.groupBy("kind", "found").agg(F.sum("n").alias("n")).filter("n > 1").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} surnames and towns: too many to send to every task")
    lex = _seen_twice(given, ((r.kind, r.found, r.n) for r in rows))
    mark = (lex.given, lex.surnames, lex.towns)
    if mark not in _fields:
        while len(_fields) >= 4:
            _fields.pop(next(iter(_fields)))
        _fields[mark] = Field().fit(labelled_text(lex))
    return Model(lex, _fields[mark])


def _finder(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, kinds, values = [], [], []
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if t:
                    seen = dict.fromkeys((s.type, t[s.start : s.end]) for s in model.find(t))
                    ids += [d] * len(seen)
                    kinds += [k for k, _ in seen]
                    values += [v for _, v in seen]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(kinds, pa.string()), pa.array(values, pa.string())], ["doc_id", "pii_type", "pii_text"])

    return run


def _redactor(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t in b.column(1).to_pylist():
                if t:
                    parts, at = [], 0
                    for s in model.find(t):
                        parts += [t[at : s.start], f"[{s.type.upper()}]"]
                        at = s.end
                    t = "".join(parts) + t[at:]
                out.append(t)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], ["doc_id", "text"])

    return run


def find(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, pii_type, pii_text): each distinct segment once per row of the documents. A map: no shuffle, whole texts; null and empty texts give none."""
    ship(documents.sparkSession)
    return documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(_finder(model), "doc_id long, pii_type string, pii_text string")


def redact(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, text) with every segment replaced by its type in brackets; null and empty texts stay as they are."""
    ship(documents.sparkSession)
    return documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(_redactor(model), "doc_id long, text string")
