"""Personal data: candidate spans, boosted trees, calibrated thresholds.

The base kinds (email, ip, card, phone) are kept where their validation holds.
High-recall generators then propose further spans of looser formats, which may
overlap each other.  Each loose kind has its own boosted trees, which see a
proposal's format and the weights of the words around it, all as integers; a
word's weight is its log-odds in labelled rows, not set by hand.  A proposal
is taken when its score reaches its kind's calibrated threshold, it overlaps
no base span, and it beats the proposal beside it in a sweep from the left.

All work on documents is native column expressions.  A kind's matches are
``regexp_extract_all``; their positions are running sums of the lengths of
matches and of the pieces that ``split`` leaves between them.  Running values
are taken in blocks of about sqrt(n) elements, and overlaps by one sweep over
sorted spans, so the work on a text with n matches stays far below n * n.  The
expressions use possessive or bounded loops and start only at run starts, so no
text makes them backtrack without bound.

The trees are fitted once a process on TRAIN_ROWS generated, labelled
sentences whose candidates and features come from the same native expressions;
the tests measure precision and recall on sentences written by hand.

Defined cases: a null text is empty; a null doc_id is kept; repeated rows are
handled alike; an empty table gives no rows; of two overlapping proposals with
one score the left one stays (then the kind listed first).
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_and_text, spans_sql, table

#: Labelled sentences: a third each weighs words, fits the trees and calibrates the thresholds.
TRAIN_ROWS = 21_600
TREES, RATE, MIN_LEAF = 24, 0.3, 8
#: Rows that must hold a word before it has a weight, and the unit of weights.
WORD_ROWS, WEIGHT_UNIT = 3, 10
#: A kind's threshold is the lowest at which its calibration precision reaches this.
PRECISION = 0.99
#: Characters of context before and after a match.
BEFORE, AFTER = 40, 12

BASE = ("email", "ip", "card", "phone")
LOOSE = ("at", "tel", "ssn", "id", "iban", "birth", "net", "name", "key")
KINDS = BASE + LOOSE
#: Kinds that are looked for only in texts with a digit.
WITH_DIGIT = tuple(k for k in KINDS if k not in ("email", "at", "name"))

_LOCAL = "A-Za-z0-9._%+-"
_AT = r"(?:\x20?[\[({<]\x20?(?:at|AT|@)\x20?[\])}>]\x20?|\x20(?:at|AT|@)\x20|\x20@|@\x20)"
_DOT = r"(?:\x20?[\[({<]\x20?(?:dot|DOT|\.)\x20?[\])}>]\x20?|\x20(?:dot|DOT)\x20|\.)"
_NO_ALNUM = "(?<![0-9A-Za-z])"
_CUE = "[Nn]ame is|[Nn]ame:|[Ii] am|Mr|Mr\\.|Mrs|Mrs\\.|Ms|Ms\\.|Dr|Dr\\.|Herr|Herrn|Frau|Señor|Señora|Sr\\.|Sra\\.|Monsieur|Madame|Mme|Dear|Liebe|Lieber|Contact:|contact|Sincerely,|Regards,|[Pp]atient|[Pp]atient:"
#: kind -> (cheap expression that must occur, expression of the span)
PATTERNS = {
    "email": ("@", rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (r"[0-9](?:[\x20-]?[0-9]){13}", r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": (r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]"),
    "at": (r"[\x20\[({<](?:at|AT|@)[\x20\])}>]|@\x20|\x20@", rf"(?<![{_LOCAL}])[{_LOCAL}]{{1,64}}+{_AT}[A-Za-z0-9-]{{1,63}}+(?:{_DOT}[A-Za-z0-9-]{{2,24}}+){{1,4}}+"),
    "tel": (r"[0-9][\x20()./-]{0,2}[0-9]{2}[\x20()./-]{0,2}[0-9]{2}", r"(?<![0-9A-Za-z+.,/:-])(?:\([0-9]{1,5}\)\x20?|[0-9]{1,5}[\x20./-])(?:\(?[0-9]{1,5}\)?[\x20./-]){0,5}[0-9]{2,8}(?![0-9A-Za-z]|[.,/:-][0-9])|(?<![0-9A-Za-z+.,/:-])[0-9]{7,12}(?![0-9A-Za-z]|[.,/:-][0-9])"),
    "ssn": (r"[0-9]{3}[\x20.-][0-9]{2}[\x20.-][0-9]{4}", r"(?<![0-9A-Za-z.-])[0-9]{3}([\x20.-])[0-9]{2}\1[0-9]{4}(?![0-9A-Za-z]|[.-][0-9])"),
    "id": (r"[0-9]{2}\x20?[0-9]{2}\x20?[0-9]{2}", _NO_ALNUM + r"(?:[A-Z]{2}\x20?[0-9]{2}\x20?[0-9]{2}\x20?[0-9]{2}\x20?[A-Z]|[A-Z]{1,3}\x20?[0-9]{5,10}[A-Z]{0,2}|[0-9]{8,12}[A-Z]?)(?![0-9A-Za-z])"),
    "iban": (r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}", _NO_ALNUM + r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"),
    "birth": (r"(?:19|20)[0-9]{2}", r"(?<![0-9A-Za-z./-])(?:[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}[./-][0-9]{1,2}[./-][0-9]{1,2}|[0-9]{1,2}\.?\x20(?:de\x20)?\p{L}{3,10}\x20(?:de\x20)?(?:19|20)[0-9]{2}|[A-Z]\p{L}{2,9}\x20[0-9]{1,2},\x20(?:19|20)[0-9]{2})(?![0-9A-Za-z]|[./-][0-9])"),
    "net": (r":[0-9A-Fa-f]{1,4}:{1,2}[0-9A-Fa-f]|-[0-9A-Fa-f]{2}-[0-9A-Fa-f]{2}-[0-9A-Fa-f]{2}-", r"(?<![0-9A-Za-z:.-])(?:[0-9A-Fa-f]{1,4}(?::{1,2}[0-9A-Fa-f]{1,4}){2,7}|[0-9A-Fa-f]{2}(?:-[0-9A-Fa-f]{2}){5})(?![0-9A-Za-z:-])"),
    "name": (rf"\x20[A-Z](?<=(?:{_CUE})\x20[A-Z])", rf"[A-Z](?<=(?<!\p{{L}})(?:{_CUE})\x20[A-Z])[\p{{L}}'’-]{{1,20}}+(?:\x20[A-Z][\p{{L}}'’-]{{1,20}}+){{0,2}}+"),
}
# credentials: long runs with a digit and a letter
PATTERNS["key"] = (r"[A-Za-z0-9+/_-]{16}", r"(?<![A-Za-z0-9+/_=.@-])(?=[A-Za-z+/_-]{0,127}[0-9])(?=[0-9+/_-]{0,127}[A-Za-z])[A-Za-z0-9+/_-]{16,128}+={0,2}+(?![A-Za-z0-9+/_=@-])")
PLACES = "array<struct<start:long,end:long,value:string,before:string,after:string>>"


_fresh = itertools.count()


def bind(value: str, body: Callable[[str], str]) -> str:
    """body(value) as SQL, with value computed once."""
    return f"element_at({each(f'array({value})', body)}, 1)"


def each(xs: str, body: Callable[..., str], name: str = "transform") -> str:
    """A higher-order function (transform, filter) over an array; body takes an element and maybe its place from 0."""
    x, i = f"x{next(_fresh)}", f"i{next(_fresh)}"
    two = body.__code__.co_argcount - len(body.__defaults__ or ()) == 2
    return f"{name}({xs}, ({x}, {i}) -> {body(x, i)})" if two else f"{name}({xs}, {x} -> {body(x)})"


def fold(xs: str, first: str, step: Callable[[str, str], str], last: Callable[[str], str] = str) -> str:
    a, x, z = (f"{n}{next(_fresh)}" for n in "axz")
    return f"aggregate({xs}, {first}, ({a}, {x}) -> {step(a, x)}, {z} -> {last(z)})"


def _pair(*parts: str) -> str:
    return "named_struct(" + ", ".join(f"'{n}', {v}" for n, v in zip(parts[::2], parts[1::2], strict=True)) + ")"


def raw(pattern: str) -> str:
    """An expression's text as a literal."""
    return "r'" + pattern.replace("'", r"\x27") + "'"


LONGS = "cast(array() as array<bigint>)"


def running(values: str, zero: str, add: Callable[[str, str], str]) -> str:
    """Running values of an array of longs, in blocks of about sqrt(n); add must be associative, with zero as its neutral element."""

    def grown(xs: str, first: str) -> str:
        return fold(xs, f"named_struct('at', {first}, 'out', {LONGS})", lambda a, x: bind(add(f"{a}.at", x), lambda v: f"named_struct('at', {v}, 'out', array_append({a}.out, {v}))"), lambda z: f"{z}.out")

    def run(x: str) -> str:
        blocks = each(f"sequence(0, cast(floor((size({x}.v) - 1) / {x}.b) as int))", lambda k: f"slice({x}.v, {k} * {x}.b + 1, {x}.b)")
        ends = lambda bs: grown(each(bs, lambda b: fold(b, zero, add)), zero)
        return bind(blocks, lambda bs: bind(ends(bs), lambda e: f"flatten({each(bs, lambda b, k: grown(b, f'if({k} = 0, {zero}, element_at({e}, {k}))'))})"))

    return bind(values, lambda vs: f"if(size({vs}) > 0, {bind(_pair('v', vs, 'b', f'cast(ceil(sqrt(size({vs}))) as int)'), run)}, {LONGS})")


ZERO = "0L"


def matches(text: str, kind: str) -> str:
    """Leftmost non-overlapping matches with their places (code points) and context; the expression runs only where its cheap part occurs."""
    need, pattern = PATTERNS[kind]

    def placed(x: str) -> str:
        ends = running(each(f"{x}.found", lambda v, i: f"cast(length({v}) + length(get({x}.gaps, {i})) as bigint)"), ZERO, lambda a, b: f"{a} + {b}")
        place = lambda e: lambda v, i: f"named_struct('start', get({e}, {i}) - length({v}), 'end', get({e}, {i}), 'value', {v}, 'before', right(get({x}.gaps, {i}), {BEFORE}), 'after', left(get({x}.gaps, {i} + 1), {AFTER}))"
        return bind(ends, lambda e: each(f"{x}.found", place(e)))

    some = f"contains({text}, '@')" if need == "@" else f"rlike({text}, {raw(need)})"
    every = bind(f"regexp_extract_all({text}, {raw(pattern)}, 0)", lambda f: f"if(size({f}) > 0, {bind(_pair('found', f, 'gaps', f'split({text}, {raw(pattern)}, -1)'), placed)}, null)")
    return f"cast(if({some}, {every}, null) as {PLACES})"


def digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def luhn(d: str) -> str:
    def add(acc: str, i: str) -> str:
        return bind(f"cast(substring({d}, -{i}, 1) as int)", lambda x: f"{acc} + if({i} % 2 = 0, if({x} > 4, 2 * {x} - 9, 2 * {x}), {x})")

    return f"{fold(f'sequence(1, length({d}))', '0', add)} % 10 = 0"


def valid(kind: str, value: str) -> str:
    """The validation of a base kind."""
    if kind == "ip":
        byte = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
        pattern = rf"^{byte}(?:\.{byte}){{3}}$"
        return f"rlike({value}, {raw(pattern)})"
    if kind == "card":
        return bind(digits(value), lambda d: f"if(length({d}) between 14 and 19, {luhn(d)}, false)")
    return f"length({digits(value)}) between 10 and 15" if kind == "phone" else "true"


# ---- features of a proposal

_ALNUM = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def mod97(value: str) -> str:
    """The remainder of an account number with its first four characters moved to the end and letters as 10 to 35."""
    bare = f"regexp_replace({value}, '[^0-9A-Z]', '')"
    chars = bind(bare, lambda x: each(f"split(concat(substring({x}, 5, 40), left({x}, 4)), '')", lambda c: f"{c} <> ''", "filter"))
    return fold(chars, "0", lambda a, c: bind(f"locate({c}, '{_ALNUM}') - 1", lambda v: f"cast(({a} * if({v} > 9, 100, 10) + {v}) % 97 as int)"))


def _edge(c: str) -> str:
    """What a neighbouring character is: 0 none or white space, 1 letter, 2 digit, 3 quote, bracket or colon, 4 currency or code sign, 5 other."""
    kinds = (r"^\s?$", r"^\p{L}$", "^[0-9]$", r"^[\x22\x27()\[\]:,.;]$", r"^[$€£#=/_%]$")
    return "case " + " ".join(f"when rlike({c}, {raw(k)}) then {i}" for i, k in enumerate(kinds)) + f" else {len(kinds)} end"


def _ints(kind: str, p: str) -> list[str]:
    """The format of a proposal, as integers; kind is SQL."""
    value = f"{p}.value"
    count = lambda other: f"length(regexp_replace({value}, {raw(other)}, ''))"
    number = lambda pattern: f"coalesce(cast(nullif(regexp_extract({value}, {raw(pattern)}, 0), '') as int), -1)"
    return [
        f"length({value})",
        count("[^0-9]"),
        count("[^A-Za-z]"),
        count("[^A-Z]"),
        count("[0-9A-Za-z]"),
        f"size(regexp_extract_all({value}, '[0-9]++', 0))",
        f"length(regexp_extract({value}, '^[^0-9]*+([0-9]++)', 1))",
        f"length(regexp_extract({value}, '([0-9]++)[^0-9]*+$', 1))",
        f"size(array_distinct(split({digits(value)}, '')))",
        count("[^(]"),
        count("[^.]"),
        count(r"[^\x20]"),
        count("[^-]"),
        count("[^:]"),
        count("[^/]"),
        count(r"[^\[\](){}<>@]"),
        number(r"^[0-9]{3}(?=[\x20.-])"),
        number("(?:19|20)[0-9]{2}"),
        f"size(split({value}, ' '))",
        f"if({kind} = 'iban', {mod97(value)}, 0)",
        _edge(f"right({p}.before, 1)"),
        _edge(f"left({p}.after, 1)"),
    ]


_NO_LETTER = r"[^\p{L}]+"


def _bag(p: str) -> str:
    """Words near a proposal: the last eight before it, those of the value itself (marked =) and the first after it (marked >)."""
    parts = lambda c: each(f"split(lower({c}), {raw(_NO_LETTER)})", lambda w: f"{w} <> ''", "filter")
    marked = lambda mark, ws: each(ws, lambda w: f"concat('{mark}', {w})")
    after = marked(">", f"slice({parts(p + '.after')}, 1, 1)")
    return f"concat(slice(reverse({parts(f'{p}.before')}), 1, 8), {marked('=', parts(f'{p}.value'))}, {after})"


# ---- fitting, on the driver, over a bounded generated sample


def _sentences(n: int, seed: int = 7) -> list[tuple[str, str, int]]:
    """(sentence, kind, label): generated; half of each kind's sentences hold personal data of it, the others look alike."""
    r = random.Random(seed)
    num = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    lead = lambda k: r.choice("123456789") + num(k - 1)
    word = lambda: "".join(r.choice(("an", "be", "ti", "or", "le", "su", "ra", "mo", "ent", "is", "ka", "no")) for _ in range(r.randint(1, 4)))
    common = "the and of to in is with for on was by my our your a please we you it this that can now also today".split()
    some = lambda k: " ".join(r.choice((word(), r.choice(common))) for _ in range(r.randint(0, k)))
    title = lambda: word().capitalize()
    hexed = lambda k: "".join(r.choice("0123456789abcdef") for _ in range(k))
    day, month, year = lambda: r.randint(1, 28), lambda: r.randint(1, 12), lambda a=1930, b=2025: r.randint(a, b)
    months = "January February March April May June July August September October November December Januar Mai Juni enero marzo julio janvier avril juillet".split()

    def dated(a: int, b: int) -> str:
        y = year(a, b)
        return r.choice((f"{day():02d}/{month():02d}/{y}", f"{day()}.{month()}.{y}", f"{y}-{month():02d}-{day():02d}", f"{day():02d}-{month():02d}-{y}", f"{day()} {r.choice(months)} {y}", f"{r.choice(months[:12])} {day()}, {y}"))

    def iban(good: bool) -> str:
        land, body = r.choice(("DE", "FR", "GB", "ES", "IT", "NL", "BE", "AT", "CH", "PL")), r.choice(("", "", "".join(r.choice("ABCDEFGHKLMNPRSTUW") for _ in range(4)))) + num(r.choice((10, 12, 14, 16))) + r.choice((num(2), r.choice("ABKMX") + num(1)))
        check = 98 - int("".join(str(_ALNUM.index(c)) for c in body + land + "00")) % 97
        raw = f"{land}{check if good else (check + r.randint(1, 90)) % 97:02d}{body}"
        return raw if r.random() < 0.4 else " ".join(raw[i : i + 4] for i in range(0, len(raw), 4))

    def tel() -> str:
        return r.choice((f"({num(3)}) {num(3)}-{num(4)}", f"{lead(3)}-{num(3)}-{num(4)}", f"{lead(3)}.{num(3)}.{num(4)}", f"{lead(3)} {num(3)} {num(4)}", f"0{num(3)} {num(6)}", f"0{num(2)} {num(4)} {num(4)}", f"0{num(4)} {num(6)}", f"0{num(2)}/{num(7)}", f"01{num(2)} {num(8)}", f"0{num(2)}-{num(8)}", f"{lead(3)}-{num(4)}", f"0{num(1)} {num(2)} {num(2)} {num(2)} {num(2)}", f"{lead(3)} {num(2)} {num(2)} {num(2)}", lead(10), f"00{num(2)} {num(3)} {num(6)}"))

    def mail(dots: bool = True) -> str:
        at = r.choice((" [at] ", " (at) ", "[at]", "(at)", " AT ", " at ", " @ ", "@ ", " {at} ", " <at> "))
        dot = r.choice((" [dot] ", " (dot) ", " dot ", "[dot]", "(dot)", " DOT ", ".")) if dots else "."
        local = r.choice((word(), f"{word()}.{word()}", f"{word()}{num(2)}", f"{word()}_{word()}"))
        return f"{local}{at}{word()}{dot}{r.choice(('com', 'org', 'net', 'de', 'fr', 'es', 'io', 'co'))}"

    cue = {
        "tel": "tel|tel.|telephone|phone|phone:|call|call me at|call us on|my mobile is|mobile|mobile:|cell|cell:|fax|fax:|ring|dial|text me at|reach me at|contact number|phone number is|whatsapp|Telefon|Tel.:|Handy|Rufnummer|téléphone|teléfono|móvil|portable|hotline|contact".split("|"),
        "ssn": "ssn|SSN:|social security number|social security|my social is|SSN is|tax id|tax number|TIN|taxpayer id|social security no|soc sec".split("|"),
        "id": "passport|passport number|passport no|passport no.|national id|id number|ID card|identity card|identity number|driver license|driving licence|licence number|license|account number|account no|bank account|account|insurance number|national insurance|NINO|Reisepass|Ausweis|Personalausweis|Konto|Kontonummer|DNI|NIE|pasaporte|passeport|patient id|medical record|member id|employee id|student id|tax id|customer id".split("|"),
        "birth": "born|born on|was born on|date of birth|date of birth:|DOB|DOB:|d.o.b.|birthday|birthday is|birthdate|birth date|geboren am|geb.|Geburtsdatum|nacido el|nacida el|fecha de nacimiento|né le|née le|date de naissance".split("|"),
        "at": "mail|email|e-mail|email:|write to|contact|contact me at|reach me|reach me at|send to|address|my address is|mailto|Mail|E-Mail|correo|courriel|ping|support|sales".split("|"),
        "net": "ip|IP address|ipv6|address|host|from|mac|MAC address|device|client|server|addr|interface|login from|connected from".split("|"),
        "key": "token|password|passwd|pwd|pass|secret|api key|api_key|apikey|access key|secret key|private key|client secret|bearer|authorization|auth|auth token|access token|refresh token|credentials|credential|session|cookie|jwt|passphrase|license key|Passwort|Kennwort|contraseña|clave|mot de passe|jeton".split("|"),
    }
    other = "order|order number|invoice|invoice no|part|part no|ref|reference|serial|version|item|code|isbn|total|sum|page|pages|model|sku|ticket|case|build|article|size|room|score|weighs|price|costs|about|line|lines|between|distance|batch|lot|tracking|Bestellung|Rechnung|Artikel|factura|pedido|commande|result|error|count|id of item|release|chapter|section|row|table|paragraph|population".split("|")
    when = "released|published|updated|on|since|until|meeting on|signed on|due|due date|effective|dated|founded|opened on|from|invoice date|delivered|expires|valid until|posted|modified|archived|version of|Stand|am|le|el|conference|deadline".split("|")
    digest = "commit|sha|sha1|sha256|md5|checksum|hash|digest|build|revision|file|image|uuid|etag|fingerprint|object|blob|layer|path|folder|download|tree|parent|node|trace|span|request|job|batch|model|version|doi|tracking|serial|order|document|record|item|archive|page|ref|branch|tag|name".split("|")
    clock = "at|from|until|time|starts at|score|ratio|verse|took|duration|scale|between|lap|um|Uhr|à".split("|")
    cued = lambda k: r.choice(cue[k]) + r.choice((" ", " ", " ", ": ", " is ", " # ") if r.random() < 0.9 else (" = ",))
    off = lambda words=other: r.choice(words) + r.choice((" ", " ", ": ", " is ", " # ", " = "))
    product = lambda: r.choice(("".join(r.choice("ABCXYZKLM") for _ in range(r.randint(1, 3))) + num(r.randint(5, 9)), lead(r.randint(8, 12))))
    person = lambda: r.choice((f"{title()} {title()}", f"{title()} {title()}", title()))
    roles = "Sir Madam Customer Customers Team Reader Readers Friend Friends Colleague Colleagues All President Minister Support Service Sales Applicant Member Members Kunde Damen Us Form Page Center Number Speaker Chairman Guest User Users Resident Neighbours Parents Students".split()
    mixed = lambda k: "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(k - 1)) + num(1)
    run = lambda: r.choice((hexed(31) + num(1), hexed(39) + num(1), hexed(39) + num(1), hexed(63) + num(1), mixed(r.randint(18, 48)), mixed(r.randint(18, 48)), mixed(20) + "/" + mixed(19), "sk_live_" + mixed(24), mixed(12) + "-" + mixed(12) + "_" + mixed(10), hexed(24) + num(1)))
    anon = lambda: r.choice((run(), uuid(), mixed(r.randint(17, 30))))
    framed = lambda x: r.choice(("{}", "{}", '"{}"', "'{}'", "`{}`")).format(x)
    uuid = lambda: f"{hexed(7)}{num(1)}-{hexed(4)}-{hexed(4)}-{hexed(4)}-{hexed(12)}"
    good: dict[str, Callable[[], str]] = {
        "tel": lambda: cued("tel") + tel() if r.random() < 0.85 else r.choice((f"({lead(3)}) {num(3)}-{num(4)}", f"{lead(3)}-{num(3)}-{num(4)}")),
        "ssn": lambda: cued("ssn") + (lambda s: f"{r.randint(1, 665):03d}{s}{r.randint(1, 99):02d}{s}{r.randint(1, 9999):04d}")(r.choice(("-", "-", " ", "."))),
        "id": lambda: cued("id") + r.choice((product(), product(), f"{r.choice('ABCEGHJ')}{r.choice('ABCEGHJ')} {num(2)} {num(2)} {num(2)} {r.choice('ABCD')}", f"{num(8)}{r.choice('TRWAG')}")),
        "iban": lambda: (r.choice(("iban ", "IBAN: ", "account ", "transfer to ", "Konto ", "cuenta ", "compte ")) if r.random() < 0.7 else "") + iban(True),
        "birth": lambda: cued("birth") + dated(1930, 2015),
        "at": lambda: (cued("at") if r.random() < 0.6 else "") + mail(),
        "net": lambda: cued("net") + r.choice((":".join(hexed(2) for _ in range(6)), "-".join(hexed(2) for _ in range(6)).upper(), ":".join(hexed(4) for _ in range(8)), f"2001:db8::{hexed(4)}:{hexed(3)}", f"fe80::{hexed(4)}:{hexed(4)}:{hexed(4)}:{hexed(4)}")),
        "key": lambda: r.choice(cue["key"]) + r.choice((" = ", "=", ": ", ":", " is ", " ", " := ")) + framed(run()),
        "name": lambda: r.choice(("my name is", "name is", "Name:", "I am", "Mr", "Mr.", "Mrs", "Mrs.", "Ms", "Ms.", "Dr", "Dr.", "Herr", "Frau", "Señor", "Señora", "Sr.", "Sra.", "Monsieur", "Madame", "Mme", "Dear", "Contact:", "Sincerely,", "Regards,", "patient", "Patient:")) + " " + person(),
    }
    bad: dict[str, Callable[[], str]] = {
        "tel": lambda: off() + r.choice((tel(), f"{lead(3)} {num(3)} {num(3)}", f"{num(1)}.{num(2)}.{num(3)}", f"{year()} {year()} {year()}", f"{num(2)}-{num(2)}-{num(4)}", f"{lead(2)} {num(2)} {num(2)} {num(2)}", lead(r.randint(7, 12)))) if r.random() < 0.7 else some(2) + " " + r.choice((f"{lead(3)} {num(3)} {num(3)}", f"{num(2)} {num(3)} {num(2)}", f"{lead(2)}.{num(3)}.{num(3)}.{num(2)}", f"{year()}/{num(2)}/{num(2)}", f"{lead(3)}.{num(3)}.{num(2)}.{num(2)}", lead(r.randint(7, 12)), f"{lead(1)} {num(1)} {num(2)} {num(2)} {num(1)}")),
        "ssn": lambda: (off() if r.random() < 0.7 else "") + (lambda s: f"{num(3)}{s}{num(2)}{s}{num(4)}")(r.choice(("-", " ", "."))),
        "id": lambda: (off() if r.random() < 0.7 else some(2) + " ") + product(),
        "iban": lambda: r.choice((iban(False), "".join(r.choice("ABCXYZ") for _ in range(2)) + num(2) + "".join(r.choice("ABCDEF0123456789") for _ in range(r.choice((12, 16, 20)))))),
        "birth": lambda: off(when) + dated(1930, 2025) if r.random() < 0.8 else some(2) + " " + dated(1930, 2025),
        "at": lambda: r.choice((f"look at {word()}.{r.choice(('com', 'org', 'net'))}", f"arrived at {word()}.{title()} {word()}", f"available at {word()}.{word()}.com", f"download at www.{word()}.org", f"{word()} at {word()}.{word()}", f"meet at {word()}.{r.choice(common)}", f"@ {word()}.{word()}", f"shop at {word()}.de", f"hosted at {word()}.io", f"sold @ {num(2)}.{num(2)}")),
        "net": lambda: off(clock) + r.choice((f"{num(2)}:{num(2)}:{num(2)}", f"{num(1)}:{num(2)}:{num(2)}", f"{num(1)}:{num(1)}:{num(1)}", f"{num(2)}:{num(2)}:{num(2)}:{num(2)}", f"{num(4)}:{num(2)}:{num(2)}")),
        "key": lambda: r.choice((r.choice(digest) + r.choice((" = ", "=", ": ", " is ", " ", " ")) + framed(anon()), some(2) + " " + anon(), f"/{word()}/{word()}{num(4)}/{word()}{word()}{word()}", f"{word()}{word()}-{word()}-{word()}{word()}-{num(3)}", f"{word()}_{word()}_{word()}_{year()}_{num(2)}_{num(2)}")),
        "name": lambda: r.choice((r.choice(("Dear", "Liebe", "Mr", "Mr.", "Madame", "Contact:", "contact", "name is", "Name:", "patient", "I am", "Regards,")) + " " + r.choice(roles), "Dear " + r.choice(roles) + " " + r.choice(roles), "contact " + r.choice(roles) + " " + title(), "I am " + r.choice(("Not", "Very", "Here", "Happy", "Sure")))),
    }
    out = []
    for i in range(n):
        kind, y = LOOSE[i % len(LOOSE)], (i // len(LOOSE)) % 2  # so that all parts are alike
        ahead = some(4) if kind != "name" or r.random() < 0.5 else ""
        out.append((f"{ahead} {(good if y else bad)[kind]()}{r.choice((' ', '. ', ', ', '; ', ') '))}{some(4)}".strip(), kind, y))
    return out


def boost(x: np.ndarray, y: np.ndarray) -> tuple[float, list]:
    """Gradient boosting for log loss; every tree has one split, then one more shared by both sides."""
    prior = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    score, trees = np.full(len(y), prior), []
    cuts = [(j, v) for j in range(x.shape[1]) for v in np.unique(np.quantile(x[:, j], np.linspace(0, 1, 33), method="lower"))[:-1]]
    if not cuts:
        return prior, trees
    sides = np.array([x[:, j] <= v for j, v in cuts], dtype=float)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)

        def leaf(m):
            return RATE * float((g * m).sum() / ((h * m).sum() + 1.0))

        def gain(mask):
            a, b, n = sides @ (g * mask), sides @ (h * mask), sides @ mask
            ga, gb, na = (g * mask).sum() - a, (h * mask).sum() - b, mask.sum() - n
            return np.where((n >= MIN_LEAF) & (na >= MIN_LEAF), a * a / (b + 1) + ga * ga / (gb + 1), -1.0)

        first = int(gain(np.ones(len(y))).argmax())
        left = sides[first]
        second = int((gain(left) + gain(1 - left)).argmax())
        low, high = sides[second], 1 - sides[second]
        values = ((leaf(left * low), leaf(left * high)), (leaf((1 - left) * low), leaf((1 - left) * high)))
        (j, v), (k, w) = cuts[first], cuts[second]
        trees.append(((j, int(v)), (k, int(w)), values))
        score += np.where(left > 0, np.where(low > 0, *values[0]), np.where(low > 0, *values[1]))
    return prior, trees


class Model:
    """Word weights and trees of one kind, with its threshold.  ``asks`` numbers the features that the trees use: the format's, then the context's."""

    def __init__(self, rows: list[tuple[int, int, list[int], list[str]]], n_rows: int):
        part = np.array([r[0] * 3 // n_rows for r in rows])
        y = np.array([r[1] for r in rows], float)
        words: dict[str, list[int]] = {}
        for k in np.flatnonzero(part == 0):
            for w in set(rows[k][3]):
                words.setdefault(w, [0, 0])[rows[k][1]] += 1
        share = y[part == 0].mean() if (part == 0).any() else 0.5
        odds = lambda no, yes: np.log((yes + share) / (no + 1 - share)) - np.log((share + 1e-3) / (1 - share + 1e-3))
        weighed = {w: round(WEIGHT_UNIT * float(odds(*n))) for w, n in sorted(words.items()) if sum(n) >= WORD_ROWS}
        self.weights = {w: v for w, v in weighed.items() if v}
        x = np.array([[*f, *self.near(bag)] for _, _, f, bag in rows], float).reshape(len(rows), -1)
        self.prior, trees = boost(x[part == 1], y[part == 1]) if (part == 1).any() else (0.0, [])
        self.asks = sorted({i for (j, _), (k, _), _ in trees for i in (j, k)})
        self.n_format = len(rows[0][2]) if rows else 0
        at = {i: n for n, i in enumerate(self.asks)}
        self.trees = [((at[j], v), (at[k], w), values) for (j, v), (k, w), values in trees]
        score, right = np.array([self.of(f[self.asks]) for f in x[part == 2]]), y[part == 2]
        order = np.argsort(-score, kind="stable")
        precision = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
        last = np.append(score[order][:-1] != score[order][1:], True) if len(order) else np.empty(0, bool)
        fine = np.flatnonzero(last & (precision >= PRECISION))
        self.threshold = float(score[order][fine[-1]]) - 1e-9 if len(fine) else float("inf")
        self.recall = float(right[score >= self.threshold].sum() / max(1, right.sum()))

    def near(self, bag: list[str]) -> list[int]:
        """The context features: sum of all weights, the first one, the greatest and the least."""
        got = [self.weights[w] for w in bag if w in self.weights]
        return [sum(got), got[0], max(got), min(got)] if got else [0, 0, 0, 0]

    def of(self, f) -> float:
        """The score of asked features; the expression adds in the same order."""
        total = self.prior
        for (j, v), (k, w), ((a, b), (c, d)) in self.trees:
            total += (a if f[k] <= w else b) if f[j] <= v else (c if f[k] <= w else d)
        return total

    def score(self, kind: str, p: str) -> str:
        """The score of a proposal, as SQL; weights and trees are literals."""
        quoted = lambda w: "'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'"
        weights = "map(" + ", ".join(f"{quoted(w)}, {v}" for w, v in (self.weights or {"": 0}).items()) + ")"
        trees = "array(" + ", ".join(f"named_struct('j', {j}, 'v', {v}, 'k', {k}, 'w', {w}, 's', array({a!r}D, {b!r}D, {c!r}D, {d!r}D))" for (j, v), (k, w), ((a, b), (c, d)) in self.trees or [((0, 0), (0, 0), ((0.0, 0.0), (0.0, 0.0)))]) + ")"
        got = each(each(_bag(p), lambda w: f"element_at({weights}, {w})"), lambda v: f"{v} is not null", "filter")
        ints = _ints(f"'{kind}'", p)
        near = lambda g: [fold(g, "0", lambda a, v: f"{a} + {v}"), f"coalesce(get({g}, 0), 0)", f"coalesce(array_max({g}), 0)", f"coalesce(array_min({g}), 0)"]
        asked = lambda g: "array(" + ", ".join(f"cast({([*ints, *near(g)])[a]} as int)" for a in self.asks or [0]) + ")"
        side = lambda f, t: f"if(get({f}, {t}.j) <= {t}.v, 0, 2) + if(get({f}, {t}.k) <= {t}.w, 0, 1)"
        total = lambda f: fold(trees, f"{self.prior!r}D", lambda acc, t: f"{acc} + get({t}.s, {side(f, t)})")
        return bind(got, lambda g: bind(asked(g), total))


_MODELS: dict[int, dict[str, Model]] = {}


def models(spark: SparkSession, rows: int = TRAIN_ROWS) -> dict[str, Model]:
    """Trees and threshold of each loose kind; fitted once a process, as only the number of rows decides them."""
    if rows not in _MODELS:
        made = _sentences(rows)
        texts = spark.createDataFrame(pa.table({"i": pa.array(range(rows), pa.int32()), "text": [m[0] for m in made], "of": [m[1] for m in made], "y": pa.array([m[2] for m in made], pa.int32())}))
        of = lambda kind: each(f"coalesce({matches('text', kind)}, cast(array() as {PLACES}))", lambda p: f"named_struct('kind', '{kind}', 'p', {p})")
        every = F.expr(f"flatten(array({', '.join(map(of, LOOSE))}))")
        seen = texts.repartition(4).select("i", "of", "y", F.explode(every).alias("x")).selectExpr("i", "x.kind", "if(of = x.kind, y, 0) as y", "x.p")
        seen = seen.selectExpr("i", "kind", "y", f"array({', '.join(f'cast({c} as int)' for c in _ints('kind', 'p'))}) as f", f"{_bag('p')} as bag")
        got: dict[str, list] = {k: [] for k in LOOSE}
        found = seen.toArrow().to_pydict()  # a few rows for each generated sentence
        for row in zip(*[found[c] for c in ("kind", "i", "y", "f", "bag")], strict=True):
            got[row[0]].append(row[1:])
        _MODELS[rows] = {k: Model(sorted(v), rows) for k, v in got.items()}
    return _MODELS[rows]


# ---- application

SPANS = "array<struct<start:long,k:int,end:long,score:double>>"
NONE = f"cast(array() as {SPANS})"
FAR = f"{1 << 62}L"
greatest, least = (lambda a, b: f"greatest({a}, {b})"), (lambda a, b: f"least({a}, {b})")


def _spans(text: str, kind: str, trees: dict[str, Model]) -> str:
    k = KINDS.index(kind)
    as_span = lambda p, score: f"named_struct('start', {p}.start, 'k', {k}, 'end', {p}.end, 'score', {score})"
    if kind in BASE:
        got = each(each(matches(text, kind), lambda p: valid(kind, f"{p}.value"), "filter"), lambda p: as_span(p, "1e9D"))
    elif trees[kind].threshold == float("inf"):
        return NONE
    else:
        model = trees[kind]
        got = each(each(matches(text, kind), lambda p: as_span(p, model.score(kind, p))), lambda s: f"{s}.score >= {model.threshold!r}D", "filter")
    return f"coalesce(cast({got} as {SPANS}), {NONE})"


def _apart(spans: str) -> str:
    """Of sorted spans those that a sweep from the left keeps: of two that overlap the better-scored one, the earlier one of equals."""

    def step(kept: str, s: str) -> str:
        swap = f"if({s}.score > element_at({kept}, -1).score, array_append(slice({kept}, 1, size({kept}) - 1), {s}), {kept})"
        return f"if(if(size({kept}) = 0, true, {s}.start >= element_at({kept}, -1).end), array_append({kept}, {s}), {swap})"

    def by_cluster(x: str) -> str:
        """Spans that no overlap connects are swept apart from each other, so no sweep is longer than its cluster."""
        firsts = each(f"sequence(0, size({x}.s) - 1)", lambda i: f"if({i} = 0, true, get({x}.s, {i}).start >= get({x}.m, {i} - 1))", "filter")
        sweep = lambda c: f"if(size({c}) = 1, {c}, {fold(c, NONE, step)})"
        cluster = lambda fs: lambda a, j: bind(f"slice({x}.s, {a} + 1, coalesce(get({fs}, {j} + 1), size({x}.s)) - {a})", sweep)
        return bind(firsts, lambda fs: f"flatten({each(fs, cluster(fs))})")

    ends = lambda s: running(each(s, lambda x: f"{x}.end"), ZERO, greatest)
    return bind(spans, lambda s: f"if(size({s}) < 2, {s}, {bind(_pair('s', s, 'm', ends(s)), by_cluster)})")


def _outside(base: str, loose: str) -> str:
    """The loose spans that overlap no base span, in order."""
    is_base = lambda s: f"{s}.k < {len(BASE)}"

    def pick(s: str) -> str:
        covered = running(each(s, lambda x: f"if({is_base(x)}, {x}.end, {ZERO})"), ZERO, greatest)
        starts = each(s, lambda x: f"if({is_base(x)}, {x}.start, {FAR})")
        ahead = f"reverse({running(f'reverse({starts})', FAR, least)})"
        free = lambda y: each(each(s, lambda x, i: f"if(not {is_base(x)} and get({y}.c, {i}) <= {x}.start and get({y}.a, {i}) >= {x}.end, {x}, null)"), lambda x: f"{x} is not null", "filter")
        return bind(_pair("c", covered, "a", ahead), free)

    return f"if(size({base}) = 0, array_sort({loose}), {bind(f'array_sort(concat({base}, {loose}))', pick)})"


def detect(spark: SparkSession, text: str) -> str:
    """SQL of all selected spans of a text (SQL, not null): struct<start, k (number of the kind), end, score>, in order."""
    trees = models(spark)

    def found(digit: bool) -> str:
        of = lambda kinds: f"concat({', '.join([NONE, *(_spans(text, k, trees) for k in kinds if digit or k not in WITH_DIGIT)])})"
        return _pair("b", of(BASE), "l", of(LOOSE))

    both = f"if(rlike({text}, '[0-9]'), {found(True)}, {found(False)})"
    chosen = lambda x: f"array_sort(if(size({x}.l) = 0, {x}.b, concat({x}.b, {_apart(_outside(f'{x}.b', f'{x}.l'))})))"
    return bind(both, chosen)


def find(docs: DataFrame) -> DataFrame:
    """doc_id, and spans of every document; no shuffle."""
    return id_and_text(docs).select("doc_id", F.expr(detect(docs.sparkSession, "coalesce(text, '')")).alias("spans"))


def redacted(text: str, spans: str) -> str:
    """SQL of the text with each span replaced by its kind in brackets; a span that begins inside those before is merged with them.

    Spans are taken in blocks of about sqrt(n), each with its own piece of the
    text, as the place of a code point is found by counting from the front.
    """
    names = "array(" + ", ".join(f"'[{k.upper()}]'" for k in KINDS) + ")"
    cut = lambda t, a, b: f"substring({t}, cast({a} + 1 as int), cast({b} - ({a}) as int))"

    def done(x: str) -> str:
        at = lambda i: f"coalesce(get({x}.m, {i}), {ZERO})"  # noqa: E731  # where what is before span i + 1 ends
        n, b = f"size({x}.s)", f"{x}.b"

        def block(k: str) -> str:
            first, last = f"({k} * {b})", f"least(({k} + 1) * {b}, {n})"
            piece = _pair("from", at(f"{first} - 1"), "t", cut(f"{x}.t", at(f"{first} - 1"), f"get({x}.m, {last} - 1)"))
            mark = lambda p: lambda s, j: f"if({s}.start >= {at(f'{first} + {j} - 1')}, concat({cut(f'{p}.t', at(f'{first} + {j} - 1') + f' - {p}.from', f'({s}.start - {p}.from)')}, element_at({names}, {s}.k + 1)), '')"
            return bind(piece, lambda p: f"array_join({each(f'slice({x}.s, {first} + 1, {last} - {first})', mark(p))}, '')")

        blocks = each(f"sequence(0, cast(floor(({n} - 1) / {b}) as int))", block)
        return f"concat(array_join({blocks}, ''), substring({x}.t, cast(element_at({x}.m, -1) + 1 as int), length({x}.t)))"

    ends = running(each(spans, lambda s: f"{s}.end"), ZERO, greatest)
    return f"if(size({spans}) > 0, {bind(_pair('t', text, 's', spans, 'm', ends, 'b', f'cast(ceil(sqrt(size({spans}))) as int)'), done)}, {text})"


def redact(docs: DataFrame) -> DataFrame:
    """The documents, all columns, with personal data replaced in text; n_chars follows where it is a column."""
    rows = docs.select(F.struct(*[docs[c].alias(c) for c in docs.columns]).alias("row"), docs["text"].alias("t"))
    rows = rows.select("row", "t", F.expr(detect(docs.sparkSession, "coalesce(t, '')")).alias("spans"))
    done = rows.select("row", F.expr(redacted("t", "spans")).alias("new"))
    return done.select(*[(F.col("new") if n == "text" else F.length("new").cast("long") if n == "n_chars" else F.col("row")[n]).alias(n) for n in docs.columns])


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = find(table(spark, sf_dir, "documents"))
    names = F.array(*map(F.lit, KINDS))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["k"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["k"] == k)).cast("long")
    more = [F.size("spans").cast("long").alias("n_spans"), F.size(F.filter("spans", lambda s: s["k"] >= len(BASE))).cast("long").alias("n_loose")]
    return got.select("doc_id", *[count(k).alias(f"n_{kind}") for k, kind in enumerate(BASE)], F.sha2(joined(F.filter("spans", lambda s: s["k"] < len(BASE))), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), *more)


_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_LUHN = f"list_sum(list_transform(string_split(reverse({_DIGITS}), ''), lambda c, i: CASE WHEN i % 2 = 0 THEN CASE WHEN c::INT > 4 THEN 2 * c::INT - 9 ELSE 2 * c::INT END ELSE c::INT END)) % 10 = 0"
#: The base columns alone, as SQL has no trees; the tests hold them against it.
BASE_SQL = spans_sql(
    [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true", "@"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "len(list_filter(string_split(v, '.'), lambda x: coalesce(try_cast(x AS HUGEINT), 256) > 255)) = 0", r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"),
        ("card", r"[0-9]([\x20-]?[0-9])+", f"CASE WHEN length({_DIGITS}) BETWEEN 14 AND 19 THEN {_LUHN} ELSE false END", r"[0-9]([\x20-]?[0-9]){13}"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 10 AND 15", r"\+[0-9]"),
    ]
)
