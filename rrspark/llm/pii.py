"""PII: format-preserving Feistel pseudonyms, in DataFrame functions only.

Three passes. First card numbers and IBANs: in every run of digits, blanks, hyphens and dots, whatever stands beside it, the
leftmost and there the longest sequence of digit groups that has 13 to 19 digits, an issuer's range and the Luhn digit
(with dots only in the groups cards are printed in, and not right after a digit and a dot, as decimals are); an IBAN by its
check digits. Then cards broken by a line end: the digits before and after it together, where they are a card. Other
groups stay for the third pass. It finds the other kinds by one pattern and validates them: dates (a calendar day of the
years 1800 to 2199, as yyyy-mm-dd, yyyy/mm/dd, d/m/yyyy, d.m.yyyy or d Mon yyyy, month first where only that is a day; a
time may follow after T), US social security numbers, IPv4 addresses (not after "version"), phone numbers (international ones with +,
and 3-3-4 digits with separators; ten bare digits are left as any number is). What doesn't validate stays. A validated value
is permuted within its own format by a keyed Feistel network over two residues (a, b): digits
over (10^u, 10^v), days of 400 years over (773, 189), addresses over (2^16, 2^16), and so on. Cards and IBANs get
their check digits anew. Separators, the country code and padding stay. As the network is a
permutation, equal values get equal pseudonyms in all documents and different values
different ones; ``reveal`` is the same network backwards, in the reverse order of passes. Where digit groups stand
right beside a card, its pseudonym may by chance pass as a longer or earlier card, which isn't revealed.

E-mail addresses and secrets (``token = "..."``, ``"api-key": '...'``, bare values of 8 characters with a digit or right after ``=``,
bearer tokens, and keys known by how they begin) are no numbers: they become keyed hashes in the form of their kind. The key is
the caller's: who has it can reveal. It is a literal of the plan; ``spark.sql.redaction.string.regex`` keeps it out of
explained ones. Everything runs in the JVM: no Python on the executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 10  # even, so the residues end up where they began
KEY_CONF = "spark.rrspark.pii.key"
DEMO_KEY = "rrspark"  # of the registered query and pipeline where the session names none: public, so no protection

# each kind by its whole form; tried in this order
KINDS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}@[\p{L}\p{N}-]{1,63}(?:\.[\p{L}\p{N}-]{1,63}){1,8}",
    "secret": r"(?i:(?<![A-Za-z0-9])(?:passw(?:or)?d|pwd|passphrase|token|secret|api[_-]?key|(?:secret|private|access)[_-]?key)"
              r"[\"']?(?:\s{0,8}[=:]\s{0,8}(?:\"[^\"\s]{6,}\"|'[^'\s]{6,}'|(?=[a-z_+/=.~-]*[0-9])[a-z0-9_+/=.~-]{8,})|=[a-z0-9_+/.~-]{8,}))"
              r"|(?i:(?<![a-z0-9])bearer\s{1,8}(?=[a-z_+/=.~-]*[0-9])[a-z0-9_+/=.~-]{16,})"
              r"|(?<![A-Za-z0-9_])(?:sk-[A-Za-z0-9_-]{20,}|A[KS]IA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,})(?![A-Za-z0-9])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?|1[ .-])?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{4}(?!\w)"
             r"|(?<![\w+])\+\d(?:[ .-]?\d){6,14}(?![\w-]|\.\d)"
             r"|(?<![\w+.-])(?:1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-]|\.\d)",
    "ssn": r"(?<![\w+.-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "date": r"(?<![\w/.-])\d{4}-\d{2}-\d{2}(?:(?=[Tt]\d)|(?![\w-]))|(?<![\w/.-])\d{4}/\d{2}/\d{2}(?![\w/-])"
            r"|(?<![\w/.-])\d{1,2}(?:/\d{1,2}/|\.\d{1,2}\.)\d{4}(?![\w/-])"
            r"|(?<![\w/.-])\d{1,2} (?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) \d{4}(?![\w-])",
    "ipv4": r"(?<!(?i:version|release)[ :]{1,2})(?<![\w.-])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\w-]|\.\d)",
}
# what card numbers are looked for in, and its digit groups, each with the separator after it
RUN = r"(?<![\d+])\d[\d .-]{11,}\d"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
GROUP = r"\d+[ .-]?|[A-Z]+|[ .-]"
DOTTED = r"^(?:\d{4}\.\d{4}\.\d{4}\.\d{4}(?:\.\d{1,3})?|\d{4}\.\d{6}\.\d{4,5})[ .-]?$"
BROKEN = r"(?<!\d)(?<![\d+][ .-])\d(?:[ -]?\d){0,17}[ -]?\r?\n[ \t]{0,8}\d(?:[ -]?\d){0,17}(?![ -]?\d)"
COUNTRY = (r"^(?:\+(?:\d{1,3}(?=[ .(-])|[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})[ .-]?"
           r"|1[ .-])?")
ANY = "|".join(f"(?:{p})" for p in KINDS.values())


def _long(c: Column) -> Column:
    return F.coalesce(c.try_cast("bigint"), F.lit(0).cast("bigint"))


def _noise(key: str, *parts: Column) -> Column:
    """A keyed 60-bit number."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts]), 256)
    return _long(F.conv(F.substring(digest, 1, 15), 16, 10))


def _state(left: Column, right: Column, a: Column, b: Column) -> Column:
    return F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"),
                    a.cast("bigint").alias("a"), b.cast("bigint").alias("b"))


def feistel(key: str, kind: Column, left: Column, right: Column, a: Column, b: Column, back: bool = False) -> Column:
    """``(l, r)`` of a keyed permutation of Z_a x Z_b at (left, right); ``back`` inverts it."""

    def forth_step(s: Column, i: Column) -> Column:
        return _state(s["r"], F.pmod(s["l"] + _noise(key, kind, i, s["a"], s["r"]), s["a"]), s["b"], s["a"])

    def back_step(s: Column, i: Column) -> Column:
        return _state(F.pmod(s["r"] - _noise(key, kind, F.lit(ROUNDS + 1) - i, s["b"], s["l"]), s["b"]), s["l"], s["b"], s["a"])

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), _state(left, right, a, b), back_step if back else forth_step)


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _permute_digits(key: str, kind: Column, digits: Column, back: bool) -> Column:
    n = F.length(digits)
    u = F.floor(n / 2).cast("int")
    power = lambda k: F.pow(F.lit(10.0), k)  # noqa: E731  exact: at most 10 digits a half
    half = feistel(key, F.concat(kind, n.cast("string")), _long(F.substring(digits, F.lit(1), u)),
                   _long(F.substring(digits, u + 1, n)), power(u), power(n - u), back)
    return _bind(half, lambda s: F.concat(F.lpad(s["l"].cast("string"), u, F.lit("0")),
                                          F.lpad(s["r"].cast("string"), n - u, F.lit("0"))))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def _fill(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced in turn."""
    def put(s: Column, c: Column) -> Column:
        digit = c.between("0", "9")
        return F.struct(F.concat(s["o"], F.when(digit, F.substring(digits, s["k"], F.lit(1))).otherwise(c)).alias("o"),
                        (s["k"] + digit.cast("int")).alias("k"))

    return F.aggregate(F.split(form, ""), F.struct(F.lit("").alias("o"), F.lit(1).alias("k")), put, lambda s: s["o"])


def _check_digit(payload: Column) -> Column:
    """Luhn: the last digit of the payload counts double, then every second."""
    def add(total: Column, i: Column) -> Column:
        d = F.substring(payload, F.length(payload) - i + 1, F.lit(1)).try_cast("int")
        return total + F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    total = F.aggregate(F.sequence(F.lit(1), F.length(payload)), F.lit(0), add)
    return ((F.lit(10) - total % 10) % 10).cast("string")


def _kept(d: Column) -> Column:
    """How many issuer digits stay."""
    return F.when(d.startswith("2"), F.lit(4)).otherwise(F.lit(1))


def _is_card(d: Column) -> Column:
    """13 to 19 digits, issuer digits 3 to 6 or 2221 to 2720, Luhn."""
    n = F.length(d)
    issued = d.substr(1, 1).between("3", "6") | d.substr(1, 4).between("2221", "2720")
    return F.when(n.between(13, 19) & issued, _check_digit(F.substring(d, F.lit(1), n - 1)) == F.substring(d, n, F.lit(1))
                  ).otherwise(F.lit(False))


def _card(key: str, m: Column, back: bool) -> Column:
    """Issuer digits stay, the check digit is made anew."""
    def of(d: Column) -> Column:
        n, kept = F.length(d), _kept(d)
        issuer = F.substring(d, F.lit(1), kept)
        inner = _permute_digits(key, F.concat(F.lit("card"), issuer), F.substring(d, kept + 1, n - 1 - kept), back)
        return _fill(m, _bind(F.concat(issuer, inner), lambda p: F.concat(p, _check_digit(p))))

    return _bind(_digits(m), of)


def _cards(key: str, run: Column, back: bool) -> Column:
    """A run with its card numbers replaced: from the left, at each group the longest sequence that is one."""
    def within(groups: Column) -> Column:
        def longest(i: Column) -> Column:
            """Groups of the longest card from group i on, 0 if there is none."""
            def of(g: Column) -> Column:
                def card(k: Column) -> Column:
                    whole = F.array_join(F.slice(g, F.lit(1), k), "")
                    return (F.forall(F.slice(g, F.lit(1), k), lambda x: x.rlike("^[0-9]")) & _bind(_digits(whole), _is_card)
                            & (~F.regexp_replace(whole, r"\.$", "").contains(".") | whole.rlike(DOTTED)))

                ends = F.filter(F.sequence(F.size(g), F.lit(1), F.lit(-1)), lambda k: F.when(
                    F.length(F.array_join(F.slice(g, F.lit(1), k), "")) < 13, F.lit(False)).otherwise(card(k)))
                return F.coalesce(F.get(ends, F.lit(0)), F.lit(0))

            begins = F.element_at(groups, i).rlike("^[2-6]") & ~F.coalesce(F.get(groups, i - 2).rlike(r"[0-9]\.$"), F.lit(False))
            return F.when(begins, _bind(F.slice(groups, i, F.lit(19)), of)).otherwise(F.lit(0))

        found = F.filter(F.transform(F.sequence(F.lit(1), F.size(groups)), lambda i: F.struct(
            i.alias("i"), longest(i).alias("k"))), lambda p: p["k"] > 0)

        def text(start: Column, n: Column) -> Column:
            return F.array_join(F.slice(groups, start, n), "")

        def take(s: Column, p: Column) -> Column:
            replaced = F.struct((p["i"] + p["k"] - 1).alias("end"), F.concat(s["out"], F.array(
                text(s["end"] + 1, p["i"] - s["end"] - 1), _card(key, text(p["i"], p["k"]), back))).alias("out"))
            return F.when(p["i"] > s["end"], replaced).otherwise(s)

        start = F.struct(F.lit(0).alias("end"), F.array().cast("array<string>").alias("out"))
        return F.aggregate(found, start, take, lambda s: F.concat(
            F.array_join(s["out"], ""), text(s["end"] + 1, F.size(groups) - s["end"])))

    return _bind(F.regexp_extract_all(run, F.lit(GROUP), F.lit(0)), within)


def _broken_card(key: str, m: Column, back: bool) -> Column:
    """A match of BROKEN: a card if all its digits together are one."""
    return F.when(_bind(_digits(m), _is_card), _card(key, m, back)).otherwise(m)


def _mod97(text: Column) -> Column:
    def add(rest: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), (rest * 10 + F.ascii(c) - 48) % 97).otherwise((rest * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), add)


def _is_iban(m: Column) -> Column:
    bare = F.replace(m, F.lit(" "), F.lit(""))
    return F.length(bare).between(15, 34) & (_mod97(F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, 1, 4))) == 1)


def _iban(key: str, m: Column, back: bool) -> Column:
    """Country and letters stay, the last 18 digits of the rest are permuted, the check digits are made anew."""
    def of(bare: Column) -> Column:
        country = F.substring(bare, 1, 2)

        def filled(digits: Column) -> Column:
            u = F.greatest(F.length(digits) - 18, F.lit(0))
            new = F.concat(F.substring(digits, F.lit(1), u), _permute_digits(
                key, F.concat(F.lit("iban"), country), F.substring(digits, u + 1, F.length(digits)), back))
            return _bind(_fill(F.substring(bare, F.lit(5), F.length(bare)), new), lambda rest: F.concat(
                country, F.lpad((F.lit(98) - _mod97(F.concat(rest, country, F.lit("00")))).cast("string"), 2, "0"), rest))

        return _bind(_digits(F.substring(bare, F.lit(5), F.length(bare))), filled)

    def spaced(new: Column) -> Column:
        def put(s: Column, c: Column) -> Column:
            blank = c == " "
            return F.struct(F.concat(s["o"], F.when(blank, c).otherwise(F.substring(new, s["k"], F.lit(1)))).alias("o"),
                            (s["k"] + (~blank).cast("int")).alias("k"))

        return F.aggregate(F.filter(F.split(m, ""), lambda c: c != ""), F.struct(F.lit("").alias("o"), F.lit(1).alias("k")), put,
                           lambda s: s["o"])

    return _bind(_bind(F.replace(m, F.lit(" "), F.lit("")), of), spaced)


def _numbers(key: str, m: Column, back: bool) -> Column:
    """A match of IBAN or RUN."""
    shaped = m.rlike(r"^[A-Z]")
    return F.when(shaped & _is_iban(m), _iban(key, m, back)).otherwise(_cards(key, m, back))


def _phone(key: str, m: Column, back: bool) -> Column:
    code = F.regexp_extract(m, COUNTRY, 0)
    rest = F.substring(m, F.length(code) + 1, F.length(m))
    return F.concat(code, _fill(rest, _permute_digits(key, F.lit("phone"), _digits(rest), back)))


def _ssn(key: str, m: Column, back: bool) -> Column:
    """Area 001 to 899 but 666, group 01 to 99, serial 0001 to 9999."""
    area, group, serial = (_long(F.substring(m, *p)) for p in ((1, 3), (5, 2), (8, 4)))
    left = area - 1 - (area > 666).cast("int")
    half = feistel(key, F.lit("ssn"), left, (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), back)
    text = _bind(half, lambda s: F.concat_ws(
        "-", F.lpad((s["l"] + 1 + (s["l"] >= 665).cast("int")).cast("string"), 3, "0"),
        F.lpad((F.floor(s["r"] / 9999) + 1).cast("string"), 2, "0"), F.lpad((s["r"] % 9999 + 1).cast("string"), 4, "0")))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    return F.when(valid, text).otherwise(m)


def _ipv4(key: str, m: Column, back: bool) -> Column:
    def of(o: Column) -> Column:
        half = feistel(key, F.lit("ipv4"), o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536), back)
        text = _bind(half, lambda s: F.concat_ws(".", *[x.cast("string") for h in ("l", "r") for x in (
            F.shiftright(s[h], 8), s[h].bitwiseAND(255))]))
        return F.when(F.array_max(o) <= 255, text).otherwise(m)

    return _bind(F.transform(F.split(m, r"\."), _long), of)


def _date(key: str, m: Column, back: bool) -> Column:
    slashed = F.regexp_replace(m, r"\.", "/")
    day = lambda form, c=slashed: F.try_to_timestamp(c, F.lit(form)).cast("date")
    iso, named = m.rlike("^[0-9]{4}[/-]"), m.contains(" ")
    month_first = day("d/M/yyyy").isNull()
    date = F.when(iso, day("yyyy/MM/dd", F.regexp_replace(m, "-", "/"))).when(named, day("d MMM yyyy", m)).otherwise(
        F.coalesce(day("d/M/yyyy"), day("M/d/yyyy")))

    def of(d: Column) -> Column:
        index = F.datediff(d, F.lit("1800-01-01").cast("date")).cast("bigint")
        half = feistel(key, F.lit("date"), F.floor(index / 189), index % 189, F.lit(773), F.lit(189), back)
        new = _bind(half, lambda s: F.date_add(F.lit("1800-01-01").cast("date"), (s["l"] * 189 + s["r"]).cast("int")))

        def shown(x: Column) -> Column:
            padded = F.length(m) == 10
            forms = lambda pad, bare: F.when(padded, F.date_format(x, pad)).otherwise(F.date_format(x, bare))
            text = F.when(month_first, forms("MM/dd/yyyy", "M/d/yyyy")).otherwise(forms("dd/MM/yyyy", "d/M/yyyy"))
            named_day = F.when(m.startswith("0"), F.date_format(x, "dd MMM yyyy")).otherwise(F.date_format(x, "d MMM yyyy"))
            return F.when(m.contains("-"), F.date_format(x, "yyyy-MM-dd")).when(iso, F.date_format(x, "yyyy/MM/dd")).when(
                named, named_day).when(
                F.contains(m, F.lit(".")), F.regexp_replace(text, "/", ".")).otherwise(text)

        return F.when(F.year(d).between(1800, 2199), _bind(new, shown)).otherwise(m)

    return F.coalesce(_bind(date, of), m)


def _hex(key: str, kind: str, value: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), value), 256)


def _email(key: str, m: Column) -> Column:
    low = F.lower(m)
    return F.concat(F.lit("u"), F.substring(_hex(key, "email", low), 1, 12), F.lit("@d"),
                    F.substring(_hex(key, "domain", F.substring_index(low, "@", -1)), 1, 8), F.lit(".invalid"))


def _secret(key: str, m: Column) -> Column:
    part = lambda i: F.regexp_extract(m, r"^((?i:bearer\s+|sk-|a[ks]ia|gh[pousr]_|xox[abprs]-)|[^=:]*[=:]\s*[\"']?|)(.*?)([\"']?)$", i)

    def of(value: Column) -> Column:
        digest = F.concat(*[_hex(key, f"secret{i}", value) for i in range(4)])
        n = F.length(value)
        return F.substring(F.repeat(digest, (n / 256).cast("int") + 1), F.lit(1), n)

    return F.concat(part(1), _bind(part(2), of), part(3))


def _replaced(key: str, m: Column, back: bool) -> Column:
    whole = lambda kind: m.rlike(f"^(?:{KINDS[kind]})$")
    out = F.when(whole("secret"), m if back else _secret(key, m)).when(m.contains("@"), m if back else _email(key, m))
    for kind, of in (("phone", _phone), ("ssn", _ssn), ("date", _date), ("ipv4", _ipv4)):
        out = out.when(whole(kind), of(key, m, back))
    return out.otherwise(m)


def _pass(text: Column, pattern: str, replaced: Callable[[Column], Column]) -> Column:
    """``text`` with every match of the pattern replaced."""
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), replaced)
    joined = F.array_join(F.zip_with(F.split(text, pattern, -1), found, lambda t, f: F.concat(t, F.coalesce(f, F.lit("")))), "")
    return F.when(text.rlike("[0-9@\"':=]|sk-|xox") & text.rlike(pattern), joined).otherwise(text)


def pseudonymise(docs: DataFrame, key: str, column: str = "text", back: bool = False) -> DataFrame:
    """``docs`` with the personal data in ``column`` replaced; all other columns stay.

    Null texts stay null, texts without personal data stay as they are. Repeated rows are treated alike.
    """
    passes = [(f"{IBAN}|{RUN}", lambda m: _numbers(key, m, back)), (BROKEN, lambda m: _broken_card(key, m, back)),
              (ANY, lambda m: _replaced(key, m, back))]
    for pattern, replaced in reversed(passes) if back else passes:
        docs = docs.withColumn(column, _pass(F.col(column), pattern, replaced))
    return docs


def reveal(docs: DataFrame, key: str, column: str = "text") -> DataFrame:
    """Numbers and dates as they were before ``pseudonymise`` with the same key."""
    return pseudonymise(docs, key, column, back=True)


def session_key(spark: SparkSession) -> str:
    """The key that the session's KEY_CONF names, else DEMO_KEY."""
    return spark.conf.get(KEY_CONF, DEMO_KEY)


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """``doc_id, text, n_chars``: the pseudonymised text and its code points."""
    return pseudonymise(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), key).withColumn(
        "n_chars", F.length("text").cast("long"))
