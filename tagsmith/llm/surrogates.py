"""Personal data replaced by keyed surrogates.

An entity is found by its pattern, checked (Luhn, mod 97, octets) and brought
to a normal form (a phone number's digits, a lower-case mail address, one word
of a name).  A keyed hash of (type, normal form) draws a replacement of the
same type: digits for digits, letters for letters of the same script and case,
valid check digits, names with an ending of the same gender, reserved domains
and address ranges.  Each occurrence gets the replacement in its own format
(separators, case), so all mentions of an entity stay the same entity.

Names are found behind forms of address, salutations, field labels and closing
lines of letters; in the same text their other mentions are found too, in any
spelling that begins with a capital (an ordinary word in small letters is no
mention: Mr Stone may throw a stone).  A name is one entity whether it stands
as a given or a family name.  Its gender is the one gender that its forms of
address in the whole corpus have, else none.  Dates of birth and passport
numbers are found behind their labels, street addresses by house number and
kind of street; a date stays a date in its own format, an address keeps its
kind of street.

Draws are checked over the whole corpus: no two entities of a type may share
a replacement, and no replacement may be another entity's original.  Colliding
entities draw again with the next attempt number, until none collides.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagsmith.llm.common import add_columns, fresh, map_batches, ship, stash

HONORIFICS = {  # fixed values: form of address -> gender
    "Mr": "m", "Sir": "m", "Herr": "m", "Herrn": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Signor": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Mademoiselle": "f", "Señora": "f",
    "Sra": "f", "Señorita": "f", "Signora": "f", "Господин": "m", "Госпожа": "f", "Κύριος": "m", "Κυρία": "f",
    "Dr": "n", "Prof": "n",
}
SYLLABLES = {  # fixed values: opening and inner syllables, and endings by gender, of each script's made-up names
    "latin": ("ba be bi da de di fa fe ga ka ke ki la le li ma me mi na ne ni pa pe ra re ri sa se ta te va ve".split(),
              {"m": "no ro lo do to mo".split(), "f": "na ra la da ta ma".split(), "n": "ne re le den ten mer".split()}),
    "cyrillic": ("ба бе би ва ве га да де ди ка ки ла ле ли ма ме ми на не ни па ра ре ри са се та те".split(),
                 {"m": "лан рим дан тан мир нов".split(), "f": "на ра ла да та ва".split(), "n": "ко ло мо ро то но".split()}),
    "greek": ("βα βε γα γε δα δε κα κε λα λε λι μα με μι να νε νι πα πε ρα ρε σα σε τα τε".split(),
              {"m": "νος ρος λος μος τος δος".split(), "f": "να ρα λα μα τα δα".split(), "n": "νη ρη λη μη τη δη".split()}),
}

GREETINGS = "Dear Liebe Lieber Cher Chère Querido Querida".split()  # fixed values: words before a name in a letter
LABELS = ("Name Contact Attn Attention Patient Applicant Employee Signed Kontakt Ansprechpartner Ansprechpartnerin "
          "Contacto Nombre Nom").split()  # fixed values: labels before a full name
CLOSINGS = "Regards regards Sincerely sincerely Grüße Grüßen".split()  # fixed values: a name follows on the next line
NOT_NAMES = frozenset((  # fixed values: capitalised words that follow these cues without being names
    "All Applicant Authority Board Buyer Candidate Center Centre Client Colleague Colleagues Committee Community Council Customer "
    "Customers Department Desk Diary Director Editor Everyone Family Form Friend Friends Guest Guests Information Kollegen Kunde "
    "Kunden Lady Ladies Madam Manager Member Members Office Parents Partner Players Reader Readers Representative Sales Seller "
    "Service Services Sir Sirs Student Students Subscriber Supplier Support Teacher Team The User Users Visitor Your Us").split())
MONTHS = ("January February March April May June July August September October November December").split()  # fixed values
STREETS = "Street St Avenue Ave Road Rd Lane Ln Drive Boulevard Blvd Court Square Terrace Way Crescent".split()  # fixed values

# every form of address contains one of its stems
_STEMS = tuple(h for h in HONORIFICS if not any(o != h and o in h for o in HONORIFICS))
_name = "|".join(sorted(HONORIFICS, key=len, reverse=True))
_DAY = rf"\d{{4,4000}}-\d\d-\d\d|\d\d?(?P<sep>[./-])\d\d?(?P=sep)\d{{4,4000}}|\d\d? (?:{'|'.join(MONTHS)}),? \d{{4,4000}}|(?:{'|'.join(MONTHS)}) \d\d?,? \d{{4,4000}}"
_STREET = re.compile(
    rf"\b(?P<n1>\d{{1,6}})[A-Za-z]? (?P<s1>[A-Z][\w'’-]*(?: [A-Z][\w'’-]*){{0,2}}?) (?:{'|'.join(STREETS)})\b"
    rf"|\b(?P<s2>[^\W\d_a-z][\w-]{{0,40}}?)(?:straße|strasse|str\.|weg|platz|allee|gasse) (?P<n2>\d{{1,6}})[a-z]?\b"
    rf"|\b(?P<n3>\d{{1,6}})(?: ?(?:bis|ter))?,? (?:rue|avenue|boulevard|chemin|place) (?:(?:de|du|des|de la|de l['’]|d['’]) ?)?(?P<s3>[^\W\d_a-z][\w'’-]*(?: [^\W\d_a-z][\w'’-]*){{0,2}})")
_SECRET = r"password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth[_-]?token"
# (type, texts of which one must occur, pattern, group that is the entity), most specific first
PATTERNS: list[tuple[str, tuple[str, ...], re.Pattern, int]] = [
    ("private_key", ("PRIVATE KEY",), re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----\s*([A-Za-z0-9+/=\s]+?)\s*-----END [A-Z ]*PRIVATE KEY-----"), 1),
    ("jwt", ("eyJ",), re.compile(r"\beyJ[\w-]{8,}\.[\w-]{8,}\.[\w-]{8,}"), 0),
    ("key", ("AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-", "xox", "AIza"), re.compile(r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b|\bgh[pousr]_[A-Za-z0-9]{20,}|\bsk-[A-Za-z0-9_-]{20,}|\bxox[abprs]-[A-Za-z0-9-]{10,}|\bAIza[\w-]{35}"), 0),
    ("secret", ("=", ":"), re.compile(rf"(?i)\b(?:{_SECRET})\b[\"']?\s*[:=]\s*[\"']?([^\s\"',;]{{6,}})"), 1),
    ("email", ("@",), re.compile(r"(?<![\w.+-])[\w.+-]*\w@(?:[^\W_](?:[\w-]*[^\W_])?\.)+[^\W\d_]{2,}"), 0),
    ("passport", ("asspor", "ASSPOR", "eisepass", "asaport"), re.compile(r"\b(?i:passport|reisepass|passeport|pasaporte)(?i: *(?:no|nr|number|num|nummer)\b\.?)? *[:#]? *((?=(?:[A-Z]{0,9}\d){4})[A-Z0-9]{6,4000})(?![\w-])"), 1),
    ("birth", ("irth", "IRTH", "orn ", "DOB", "Geburt", "geburt"), re.compile(
        rf"\b(?i:date of birth|birth ?date|birthday|dob|born(?: on)?|geburtsdatum|geburtstag|geboren am)\b *[:,]? *({_DAY})(?!\d|[./-]\d)"), 1),
    ("street", (*STREETS, "stra", "weg", "platz", "allee", "gasse", "rue"), _STREET, 0),
    ("iban", (), re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"), 0),
    ("card", (), re.compile(r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-]|\.\d)"), 0),
    ("ssn", ("-",), re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"), 0),
    ("ipv4", (".",), re.compile(r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)"), 0),
    ("ipv6", (":",), re.compile(r"(?:(?<![\w:.])|(?<=[G-Zg-z]:)(?!:))(?:[0-9A-Fa-f]{1,4})?:(?:[0-9A-Fa-f]{0,4}:)+[0-9A-Fa-f]{0,4}(?![\w:])"), 0),
    ("phone", (), re.compile(r"(?<![\w.+-])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}|(?:\(\d{1,4}\)[ .-]?)?\d{2,4})(?:[ .-]?\d{2,4}){1,5}(?![\w]|[.-]\d)"), 0),
    ("name", (*_STEMS, *GREETINGS, *LABELS, "egards", "incerely", "Grüße"), re.compile(  # what stands before names; they follow
        rf"\b(?:{_name})\b\.?(?: (?:{_name})\b\.?)*|\b(?P<greet>{'|'.join(GREETINGS)})\b"
        rf"|\b(?:(?P<label>{'|'.join(LABELS)}) ?:|(?P<close>{'|'.join(CLOSINGS)}),?[ \r]*\n)"), 0),
]
_WORD = re.compile(r" ([^\W\d_][\w'’-]+)")
_FIRST = re.compile(r"[ \t]{0,4}([^\W\d_][\w'’-]+)")
_RUN, _PART = re.compile(r"\w[\w'’-]*"), re.compile(r"\w+")
_MAC = re.compile(r"(?:[0-9A-Fa-f]{2}:){5}[0-9A-Fa-f]{2}")
_DATE = re.compile(r"\d\d([ .-])\d\d\1\d{4}")
_PLAIN_PHONE = re.compile(r"(?:1([ .-]))?\d{3}([ .-])\d{3}\2\d{4}")
_DIGIT, _CUE = re.compile(r"[0-9]"), re.compile(rf"(?i){_SECRET}")
_HONOR = re.compile(rf"\b({_name})\b")
_BEFORE_NAME = PATTERNS[-1][2]


def _digits(s: str) -> str:
    return "".join(c for c in s if c.isascii() and c.isdigit())


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def find(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, type, normal form) of the entities of a text, left to
    right and disjoint: what a type earlier in the list takes, the later ones
    do not see."""
    if not text:
        return []
    digit = _DIGIT.search(text) is not None
    found: list[tuple[int, int, str, str]] = []
    for kind, needs, pattern, group in PATTERNS:
        if needs and not any(n in text for n in needs) or not digit and kind in ("card", "ssn", "ipv4", "phone", "iban", "passport", "birth", "street"):
            continue
        if kind == "secret" and not _CUE.search(text) or kind == "name" and not _BEFORE_NAME.search(text) \
                or kind == "ipv6" and text.count(":") < 2:
            continue
        own = _names(text, pattern) if kind == "name" else [one for m in pattern.finditer(text) for one in _checked(kind, text, *m.span(group), m)]
        text = _masked(text, own)  # later patterns do not see what is taken
        found += own
    return sorted(found)


def _masked(text: str, taken: list[tuple[int, int, str, str]]) -> str:
    """The text with its taken spans (disjoint) blanked, in one pass."""
    if not taken:
        return text
    out, at = [], 0
    for a, b, _, _ in sorted(taken):
        out += [text[at:a], "\0" * (b - a)]
        at = b
    return "".join(out) + text[at:]


def _names(text: str, pattern: re.Pattern) -> list[tuple[int, int, str, str]]:
    """The one or two capitalised words behind forms of address and other
    cues, and the other mentions of these words in the text.  A label needs
    two words, a closing line two or a line of its own; words such as Customer
    are no names there."""
    found, forms = [], {}
    for m in pattern.finditer(text):
        taken = found[-1][1] if found else 0  # this form of address may be part of a name
        gender = next((HONORIFICS[t] for t in _HONOR.findall(m.group()) if HONORIFICS[t] != "n"), "n")
        words, at = [], m.end()
        while len(words) < 2 and (w := (_WORD if words or not m.lastgroup else _FIRST).match(text, at)) \
                and w.group(1)[0].isupper() and w.group(1) not in HONORIFICS:
            name = re.sub(r"(?:['’]s)?['’-]*$", "", w.group(1))
            words.append((w.start(1), w.start(1) + len(name), name))
            at = w.end()
            if len(name) < len(w.group(1)):
                break
        if m.lastgroup and (any(name in NOT_NAMES for _, _, name in words) or len(words) == 1 and (
                m.lastgroup == "label" or m.lastgroup == "close" and text[at:at + 1] not in ("", "\n", "\r"))):
            continue
        for i, (x, y, name) in enumerate(words):
            kind = f"given_{gender}" if len(words) > 1 and i == 0 else "family"
            if x >= taken:
                found.append((x, y, kind, name.casefold()))
            forms.setdefault(name.casefold(), (kind, name.casefold()))
    if forms:
        found += _mentions(_masked(text, found), forms, folded=True)
    return found


def _mentions(text: str, forms: dict[str, tuple[str, str]], folded: bool = False) -> list[tuple[int, int, str, str]]:
    """The occurrences of the forms between word ends, the longest first; a
    look-up per word (and per pair of joined parts), however many forms.
    ``folded``: the forms are case-folded and any spelling of them counts that
    begins with a capital."""
    most = max(len(_PART.findall(f)) for f in forms)
    found = []
    for run in _RUN.finditer(text):
        parts = [m.span() for m in _PART.finditer(text, *run.span())]
        i = 0
        while i < len(parts):
            for j in range(min(len(parts), i + most) - 1, i - 1, -1):
                form = text[parts[i][0]:parts[j][1]]
                if folded:
                    form = form.casefold() if form[0].isupper() else ""
                if form in forms:
                    found.append((parts[i][0], parts[j][1], *forms[form]))
                    i = j
                    break
            i += 1
    return found


def _who(kind: str) -> str:
    """The type within which a normal form is one entity."""
    return "name" if kind == "family" or kind.startswith("given") else kind


def _genders(found: list[tuple[int, int, str, str]]) -> dict[str, set]:
    """The genders with which a text has its names (n: none)."""
    out: dict[str, set] = {}
    for _, _, kind, norm in found:
        if _who(kind) == "name":
            out.setdefault(norm, set()).add(kind[-1] if kind.startswith("given") else "n")
    return out


def _checked(kind: str, text: str, a: int, b: int, m: re.Match) -> Iterator[tuple[int, int, str, str]]:
    s = text[a:b]
    d = _digits(s)
    if kind == "email":
        yield a, b, kind, s.lower()
    elif kind == "iban":
        flat = s.replace(" ", "")
        if 15 <= len(flat) <= 34 and _mod97(flat) == 1:
            yield a, b, kind, flat
    elif kind == "birth":
        if day := _day(s):
            yield a, b, kind, "%04d-%02d-%02d" % day[:3]
    elif kind == "street":
        n, name = (x for x in m.groups() if x) if m["n1"] or m["n3"] else (m["n2"], m["s2"])
        yield a, b, kind, f"{int(n)} {name.casefold()}"
    elif kind == "card":
        if luhn(d):
            yield a, b, "card", d
        elif len(d) in (15, 16) and d[0] in "3456":
            yield a, b, "account", d
    elif kind == "ipv4":
        if all(int(x) < 256 for x in s.split(".")):
            yield a, b, kind, ".".join(str(int(x)) for x in s.split("."))
    elif kind == "ipv6":
        if s.endswith(":") and not s.endswith("::"):
            s, b = s[:-1], b - 1
        if _MAC.fullmatch(s):
            yield a, b, kind, s.lower()
        elif s != "::":
            try:
                yield a, b, kind, ipaddress.IPv6Address(s).compressed
            except ValueError:
                pass
    elif kind == "phone":
        marked = s[0] == "+" or "(" in s or s[0] == "0" and len(d) < len(s) or _PLAIN_PHONE.fullmatch(s)
        trunk = d[0] == "0" and not _DATE.fullmatch(s)  # marked and national
        if marked and (8 if s[0] == "+" or trunk else 10) <= len(d) <= 15:
            yield a, b, kind, d
    else:
        yield a, b, kind, d if kind == "ssn" else s


def _day(s: str) -> tuple[int, int, int, str] | None:
    """(year, month, day, order of the parts) of a date, None if there is no
    such day.  Numbers alone stand as day, month, year unless only the other
    order gives a date."""
    word = re.search(r"[A-Z][a-z]+", s)
    n = [int(x) for x in re.findall(r"\d+", s)]
    if word:
        (d, y), m, order = n, MONTHS.index(word.group()) + 1, "mdy" if word.start() == 0 else "dmy"
    elif re.match(r"\d{4}", s):
        (y, m, d), order = n, "ymd"
    else:
        (d, m, y), order = n, "dmy"
        if m > 12:
            d, m, order = m, d, "mdy"
    return (y, m, d, order) if 1 <= m <= 12 and 1 <= d <= 31 - (m in (4, 6, 9, 11)) - (m == 2) * (2 + (y % 4 > 0 or y % 100 == 0 and y % 400 > 0)) else None


class _Stream:
    """Keyed pseudo-random numbers for one draw."""

    def __init__(self, key: bytes, *parts: object):
        self.seed, self.block, self.pool = hashlib.blake2b("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"), key=key, digest_size=32).digest(), 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 4:
            self.pool += hashlib.blake2b(self.seed + self.block.to_bytes(4, "little")).digest()
            self.block += 1
        v, self.pool = int.from_bytes(self.pool[:4], "little"), self.pool[4:]
        return v % n

    def of(self, options: str) -> str:
        return options[self.below(len(options))]


def _alike(s: str, r: _Stream, hexa: bool = True) -> str:
    """Every letter and digit redrawn in its class; hexadecimal stays so."""
    low, up, dec = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    if hexa and re.fullmatch(r"[0-9a-f]{8,}", s):
        return "".join(r.of("0123456789abcdef") for _ in s)
    return "".join(r.of(dec) if c.isdigit() else r.of(up) if c.isupper() else r.of(low) if c.isalpha() else c for c in s)


def script_of(word: str) -> str:
    c = next((c for c in word if c.isalpha()), "a")
    return "cyrillic" if "Ѐ" <= c <= "ӿ" else "greek" if "Ͱ" <= c <= "Ͽ" else "latin"


def _private6(r: _Stream) -> str:
    return ipaddress.IPv6Address(0xFD << 120 | sum(r.below(1 << 24) << 24 * i for i in range(5))).compressed


def draw(key: bytes, kind: str, norm: str, attempt: int = 0) -> str:
    """The replacement's normal form.  From the eighth attempt on every type
    grows by a character an attempt, dates by their year, IPv6 addresses to
    eight groups and IPv4 addresses to the range 240/4, from the sixteenth on
    to all addresses and from the 64th on to an address with a port, so that
    no format can run out of replacements."""
    r = _Stream(key, _who(kind), norm, attempt)
    extra = max(0, attempt - 7)
    if kind in ("card", "account"):
        body = norm[0] + "".join(r.of("0123456789") for _ in range(len(norm) - 2 + extra))
        if kind == "card":
            return next(body + c for c in "0123456789" if luhn(body + c))
        last = r.of("0123456789")
        return next(body + c for c in last + "0123456789" if not luhn(body + c))
    if kind == "phone":
        keep = 1 if norm[0] == "1" or norm[0] == "0" and len(norm) <= 10 else 2 if len(norm) > 10 else 0  # the country's digits
        return norm[:keep] + r.of("23456789") + "".join(r.of("0123456789") for _ in range(len(norm) - keep - 1 + extra))
    if kind == "ssn":  # the range 900-999 is never issued
        return "9" + "".join(r.of("0123456789") for _ in range(len(norm) - 1 + extra))
    if kind == "iban":
        body = _alike(norm[4:] + "0" * extra, r, hexa=False)
        return f"{norm[:2]}{98 - _mod97(norm[:2] + '00' + body):02d}{body}"
    if kind == "ipv4":
        first = 1 + r.below(255) if attempt >= 16 else 240 + r.below(16) if extra else 10
        port = f":{1024 + r.below(64512)}" if attempt >= 64 else ""
        return f"{first}.{r.below(256)}.{r.below(256)}.{r.below(256)}{port}"
    if kind == "birth":
        d = int(norm[-2:])  # both orders of a date in numbers can be told apart as before
        year = 1930 + r.below(80) if not extra else (1 + r.below(9)) * 10 ** (3 + extra) + sum(r.below(10) * 10 ** i for i in range(3 + extra))
        return f"{year}-{1 + r.below(12):02d}-{13 + r.below(16) if d > 12 else 1 + r.below(12):02d}"
    if kind == "street":
        n, name = norm.split(" ", 1)
        inner, endings = SYLLABLES[script_of(name)]
        made = "".join(inner[r.below(len(inner))] for _ in range(3 + extra)) + endings["n"][r.below(len(endings["n"]))]
        return f"{r.of('123456789')}{''.join(r.of('0123456789') for _ in n[1:])} {made}"
    if kind == "passport":
        return _alike(norm, r, hexa=False) + "".join(r.of("0123456789") for _ in range(extra))
    if kind == "ipv6":
        if _MAC.fullmatch(norm):
            return "fd" + "".join(r.of("0123456789abcdef") if c in "0123456789abcdef" else c for c in norm[2:] + ":00" * extra)
        if extra:
            return _private6(r)
        full = norm.split("::")
        groups = [[r.of("123456789abcdef") + "".join(r.of("0123456789abcdef") for _ in g[1:]) for g in side.split(":") if g] for side in full]
        first = f"fd{r.of('0123456789abcdef')}{r.of('0123456789abcdef')}"
        groups[0] = [first, *groups[0][1:]]
        return ipaddress.IPv6Address("::".join(map(":".join, groups))).compressed
    if kind == "email":
        local, host = norm.split("@", 1)
        site = _Stream(key, "host", host)  # one host stays one host
        word = _alike(local, r)
        return f"{word}{''.join(r.of('0123456789') for _ in range(max(0, 6 - len(word)) + extra))}@h{site.below(1 << 32):08x}.example"
    if _who(kind) == "name":
        inner, endings = SYLLABLES[script_of(norm)]
        gender = kind[-1] if kind.startswith("given") else "n"
        return "".join(inner[r.below(len(inner))] for _ in range(3 + extra)) + endings[gender][r.below(len(endings[gender]))]
    fixed = re.match(r"AKIA|ASIA|gh[pousr]_|sk-|xox[abprs]-|AIza|eyJ", norm) if kind in ("key", "jwt") else None
    head = fixed.group() if fixed else ""
    return head + _alike(norm[len(head):], r) + "".join(r.of("0123456789") for _ in range(extra))


def dress(kind: str, original: str, norm: str) -> str:
    """The replacement in the format of one occurrence."""
    if kind in ("card", "account", "phone", "ssn"):
        it = iter(norm)
        return "".join(next(it) if c.isascii() and c.isdigit() else c for c in original) + "".join(it)
    if kind == "birth":
        y, m, d = norm.split("-")
        order = _day(original)[3]
        if word := re.search(r"[A-Z][a-z]+", original):
            it = iter([d, y])
            return re.sub(r"\d+", lambda x: str(int(next(it))), original.replace(word.group(), MONTHS[int(m) - 1]))
        it = iter([{"y": y, "m": m, "d": d}[o] for o in order])
        return re.sub(r"\d+", lambda x: str(int(next(it))).zfill(min(2, len(x.group()))), original)
    if kind == "street":
        n, name = norm.split(" ", 1)
        m = _STREET.fullmatch(original)
        part = {m.span(g): v for g, v in (("n1", n), ("n2", n), ("n3", n), ("s1", name), ("s2", name), ("s3", name)) if m[g]}
        out, at = [], 0
        for (a, b), v in sorted(part.items()):
            out += [original[at:a], v.upper() if original[a:b].isupper() and b - a > 1 else v.capitalize()]
            at = b
        return "".join(out) + original[at:]
    if kind == "iban":
        it = iter(norm)
        return "".join(c if c == " " else next(it) for c in original) + "".join(it)
    if _who(kind) == "name":
        return norm.upper() if original.isupper() and len(original) > 1 else norm.capitalize()
    if kind == "ipv6" and original != original.lower():
        return norm.upper()
    return norm


def replace(text: str | None, key: bytes, attempt_of: Callable[[str, str], int],
            gender_of: Callable[[str], str | None] = lambda n: None) -> tuple[str | None, list[str]]:
    """(the text with its entities replaced, the types found).  A name whose
    gender ``gender_of`` does not tell has the one that the text gives it."""
    out, at, kinds = [], 0, []
    found = find(text)
    genders = _genders(found)
    for a, b, kind, norm in found:
        drawn, who = kind, _who(kind)
        if who == "name":
            sure = genders[norm] - {"n"}
            drawn = f"given_{gender_of(norm) or (min(sure) if len(sure) == 1 else 'n')}"
        out += [text[at:a], dress(kind, text[a:b], draw(key, drawn, norm, attempt_of(who, norm)))]
        at = b
        kinds.append(kind)
    return (text if not kinds else "".join(out) + text[at:]), kinds


def _redraws(docs: DataFrame, key: bytes, text_col: str) -> DataFrame:
    """(kind, norm, attempt, gender) of the entities whose first draw collides
    and of the names that texts have with different genders."""
    def found(t: pa.Table) -> pa.Table:
        rows = set()
        for x in t.column(0).to_pylist():
            got = find(x)
            rows |= {(k, n, "") for _, _, k, n in got if _who(k) != "name"}
            rows |= {("name", n, g) for n, all_g in _genders(got).items() for g in all_g}
        rows = sorted(rows)
        return pa.table([pa.array([r[i] for r in rows], pa.string()) for i in range(3)], names=["kind", "norm", "gender"])
    m, f, n = (F.max(F.when(F.col("gender") == g, 1).otherwise(0)) for g in "mfn")
    entities = stash(map_batches(docs.select(F.col(text_col).cast("string")), found, "kind string, norm string, gender string", 512)
                     .groupBy("kind", "norm").agg(m.alias("m"), f.alias("f"), n.alias("n"))
                     .select("kind", "norm", F.expr("case when m > f then 'm' when f > m then 'f' else 'n' end").alias("gender"),
                             F.expr("m + f + n > 1").alias("mixed")), "entities")

    def drawn(t: pa.Table) -> pa.Table:
        k, n, g, _, a = (t.column(i).to_pylist() for i in range(5))
        k = [f"given_{h}" if x == "name" else x for x, h in zip(k, g)]
        return t.append_column("new", pa.array([draw(key, *x) for x in zip(k, n, a)], pa.string()))
    state = entities.withColumn("attempt", F.lit(0))
    cols = ["kind", "norm", "gender", "mixed"]
    while True:
        state = stash(map_batches(state.select(*cols, "attempt"), drawn,
                                  "kind string, norm string, gender string, mixed boolean, attempt int, new string", 8192), "draws")
        first = state.groupBy("kind", "new").agg(F.min("norm").alias("owner"), F.count("*").alias("n"))
        real = entities.select("kind", F.col("norm").alias("new"), F.lit(True).alias("real"))
        clash = first.join(real, ["kind", "new"], "left").where("n > 1 or real").select(
            "kind", "new", F.when(F.col("real").isNull(), F.col("owner")).alias("owner"))
        again = state.join(clash, ["kind", "new"]).where("not (owner <=> norm)").select("kind", "norm", (F.col("attempt") + 1).alias("next"))
        again = stash(again, "redraws")
        if again.isEmpty():
            break
        state = state.join(again, ["kind", "norm"], "left").select(*cols, F.coalesce("next", "attempt").alias("attempt"))
    return state.where("attempt > 0 or mixed").select("kind", "norm", "attempt", "gender")


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text", with_types: str | None = None,
                 slice_rows: int = 200_000) -> DataFrame:
    """``docs`` with the entities in ``text_col`` replaced; ``with_types``
    names an added column with the sorted types found (one per occurrence).

    ``key`` (1 to 64 bytes) is the secret that makes replacements repeatable
    and not invertible.  Null and empty texts stay as they are.  Equal
    entities get equal replacements in all rows and languages; different ones
    get different ones.  Rows are changed in place, one by one, so ties and
    repeated rows need no rule.

    The entities that had to draw again, and the names met with different
    genders, go to the tasks by broadcast, in
    slices of ``slice_rows``; with more slices, the texts pass once per slice
    and each row collects its own entities' attempts."""
    if not 1 <= len(key) <= 64:
        raise ValueError("key must have 1 to 64 bytes")
    spark = docs.sparkSession
    ship(spark)
    slices: list[dict] = [{}]
    redraws = _redraws(docs, key, text_col)
    extra = [T.StructField(with_types, T.ArrayType(T.StringType()))] if with_types else []
    new = T.StructType([T.StructField(text_col, T.StringType()), *extra])
    noted = fresh(docs, "attempts")
    out, any_noted = docs, False

    def note(sent):
        def run(text, *before):
            mine = [{f"{w}\x1f{n}\x1f{sent.value[(w, n)]}" for _, _, k, n in find(x) if (w := _who(k), n) in sent.value} for x in text.to_pylist()]
            if before:
                mine = [m | set(b) for m, b in zip(mine, before[0].to_pylist())]
            return [pa.array([sorted(m) for m in mine], pa.list_(pa.string()))]
        return run
    for k, n, a, g in redraws.toLocalIterator():
        if len(slices[-1]) >= slice_rows:  # a full slice: note its entities in the rows and drop it
            sent = spark.sparkContext.broadcast(slices.pop())
            out = add_columns(out, [text_col] + [noted] * any_noted, note(sent),
                              T.StructType([T.StructField(noted, T.ArrayType(T.StringType()))]), 512)
            any_noted = True
            slices.append({})
        slices[-1][(k, n)] = f"{a}{g}"  # the attempt, and the gender as the last letter
    last = spark.sparkContext.broadcast(slices[-1])

    def run(text, *before):
        rows = []
        known = last.value
        for i, x in enumerate(text.to_pylist()):
            told = {tuple(e.split("\x1f")[:2]): e.rsplit("\x1f", 1)[1] for e in (before[0][i].as_py() if before else ())}

            def of(k, n):
                return told.get((k, n)) or known.get((k, n))
            rows.append(replace(x, key, lambda k, n: int((of(k, n) or "0n")[:-1]), lambda n: (of("name", n) or " ")[-1].strip()))
        made = [pa.array([r[0] for r in rows], pa.string())]
        return made + ([pa.array([sorted(r[1]) for r in rows], pa.list_(pa.string()))] if with_types else [])
    result = add_columns(out, [text_col] + [noted] * any_noted, run, new, 512)
    return result.drop(noted)
