"""Removal of credentials from names, values and URLs, by the name of their field and by their form.

There is no switch to turn it off.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

REDACTED = "[redacted]"

# A field is sensitive when its name contains one of these (patterns, any case).
SENSITIVE_WORDS = (
    "passw",
    "pwd",
    "pswd",
    "psw",
    "pword",
    "user[_-]?name",
    "login",
    "token",
    "secret",
    "cookie",
    "session",
    "credential",
    "bearer",
    "csrf",
    "xsrf",
    "api[_-]?key",
    "access[_-]?key",
    "private[_-]?key",
    "sess(?:ion)?[_-]?id",
    "signature",
    "pin[_-]?code",
)
# Words for a password in other languages.
FOREIGN_WORDS = (
    "senha", "contrase[nñÑ]a", "wachtwoord", "heslo", "kennwort", "parola", "salasana", "losenord", "lösenord", "LÖSENORD", "adgangskode",
    "jelszo", "jelszó", "JELSZÓ", "sifre", "şifre", "ŞIFRE", "пароль", "Пароль", "ПАРОЛЬ", "密码", "口令", "パスワード", "비밀번호",
)
# Sensitive as a part of a name, but for what the patterns leave out: passenger, passage, passive, passion, passing, passes,
# passed, passthrough, compass, bypass, surpass, trespass; author, authority, authentic; shipping, pine, pink, pinned, pint,
# opinion, pinpoint, spin; footprint, footpath, hotplug, hotpot.
PART_WORDS = (
    r"pass(?<!compass)(?<!bypass)(?<!surpass)(?<!trespass)(?!enger|age|iv|ion|ing|thr|e[ds](?![a-z]))",
    r"auth(?!or(?!i[sz])|entic(?!at))",
    r"pin(?<!(?<![A-Za-z])spin)(?!g|e|k|n|t|y|ion|point|ball|wheel)",
    r"otp(?!r|ath|l|o|e)",
    r"pw(?![A-Za-z])",
)
# Short names, sensitive between other characters than letters (or after an encoded character).
SHORT_WORDS = ("sid", "jwt", "sig", "cvv", "cvc", "mdp", "clave", "haslo")
# In an encoded URL the name follows the digits of an encoded quote, brace or separator.
_AFTER_CODE = "[237][0-9A-Fa-f]"
_SHORT = tuple(rf"{w}(?:(?<![A-Za-z]{w})|(?<={_AFTER_CODE}{w}))(?![A-Za-z])" for w in SHORT_WORDS)
# A field is also sensitive when it is called just this, or with a number ("user-agent" and "user_id" are not).
USER_WORD = rf"user(?:(?<![\w-]user)|(?<={_AFTER_CODE}user))[0-9]*+(?![\w-])"


def _one_of(words: Iterable[str]) -> str:
    """A pattern for any of ``words``, by their first letters, so that most positions of a text are left at once."""
    by_first: dict[str, list[str]] = {}
    for word in words:
        by_first.setdefault(word[0], []).append(word[1:])
    return f"(?=[{''.join(by_first)}])(?:" + "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in by_first.items()) + ")"


_WORDS = _one_of((*SENSITIVE_WORDS, *PART_WORDS, *_SHORT, USER_WORD, *FOREIGN_WORDS))

# Names that count as a username, and names that hold a password, in the exposure audit (patterns, any case).
USERNAME_FIELDS = ("(?:j_)?user[_-]?name", "user", "login")
_PASSWORD = _one_of(
    ("passw", "pwd", "pswd", "psw", "pword", "pin[_-]?code", *PART_WORDS[:1], *PART_WORDS[2:], *_SHORT[-3:], *FOREIGN_WORDS)
)
PASSWORD_FIELDS = (rf"[^=&;#\s\"']*?{_PASSWORD}[^=&;#\s\"']*",)

# Credentials that are known by their form, whatever the field is called (patterns).
KNOWN_FORMS = (
    r"-----BEGIN(?:[ +]|%20)(?:[A-Z0-9]+(?:[ +]|%20))*PRIVATE(?:[ +]|%20)KEY[^\x01]*",
    r"eyJ[\w-]{8,}+\.[\w-]{8,}+(?:\.[\w-]*+)?",
    r"A(?:KIA|SIA|IDA|ROA|GPA)[A-Z0-9]{12,}+",
    r"g(?:h[oprsu]_|ithub_pat_|lpat-)[\w-]{16,}+",
    r"(?:npm|hf)_[A-Za-z0-9]{16,}+",
    r"xox[abeprs]-[\w-]{10,}+",
    r"[rs]k[-_](?:(?<![A-Za-z0-9]..[-_])|(?<=%[0-9A-Fa-f]{2}..[-_]))(?:(?:live|test|proj)[-_])?[A-Za-z0-9_-]{16,}+",
    r"(?:AIza[\w-]{30,}+|ya29\.[\w-]{20,}+|SG\.[\w-]{16,}+\.[\w-]{16,}+)",
)
_KNOWN = "|".join(KNOWN_FORMS)
# Between texts that are searched together.
_APART = "\x01"
# Stretches that are long enough to hold one; a private key may have blanks.
_STRETCH = r"(?<![A-Za-z0-9+/_.%=-])[A-Za-z0-9+/_.%=-]{15,}+"
_KEY_HEAD = "-----BEGIN"
# Long strings that may be drawn at random: three parts with dots, runs of letters and digits, runs with slashes where no
# path can stand. A UUID by itself is an id.
_RUN = r"(?:[A-Za-z0-9+_-]|%2[BbFf]|%3[Dd])"
_CANDIDATE = "|".join(
    (
        _KNOWN,
        r"(?<![A-Za-z0-9_.-])[\w-]{16,}+\.[\w-]{16,}+\.[\w-]{16,}+",
        r"(?<![A-Za-z0-9+/_.:%-])[A-Za-z0-9+_-]++/[A-Za-z0-9+/_-]{15,}+={0,2}",
        rf"(?<![A-Za-z0-9+_-]){_RUN}{{20,}}+={{0,2}}",
    )
)
_UUID = r"^(?:22)?[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
#: Bounds of a string that looks drawn at random: letters and digits; changes between small letters, capitals and digits, and
#: characters outside of words, each as a share (the latter half as much unless small letters and capitals are mixed,
#: since words come out shorter then); bits of entropy a character.
LEAST_LENGTH, LEAST_TURNS, LEAST_REST, LEAST_BITS = 18, 0.25, 0.25, 3.2
_TURN = r"(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[a-z0-9])|(?<=[0-9])(?=[A-Za-z])"
_WORD_IN_NAME = r"[A-Z]?[a-z]{2,}"

_QUERY_PARAM = rf"(?i)({_WORDS}[^\s=&;#?/]*+=)[^&;#\s]*"
_USERINFO = r"//[^/?#\s]*@"
# No credential can be written inside a value without one of these characters ("http:" aside),
_MARK = r"[=%@>,;|\s]|(?<!https?):"
# and without a sensitive word or userinfo.
_SUSPECT = f"(?i){_WORDS}|{_USERINFO}"
_NAME_END = r"[^\s\"'\\=:&;,%#?/<>(){}|\[\]]*+(?:[\"'\\]|%(?:25)*(?:22|27|5c))*+"
# A sensitive word, the rest of its name, quotes, and a separator that introduces a value.
_ASSIGNMENT = rf"(?i){_WORDS}{_NAME_END}\s*+(?:\[\[:\]\]|[:=>]|%(?:25)*3[ade])\s*+(?!\[redacted\])"
# After a word for a password, a blank, comma or bar is enough to take what follows for one.
_MENTION = rf"(?i)(?:passw(?:or)?d|passphrase|pwd|secret|credential){_NAME_END}[\s,;|]"


def is_sensitive(name: Column, extra: Iterable[str] = ()) -> Column:
    """True for names whose value must not leave the parser; ``extra`` adds exact names."""
    hit = name.rlike("(?i)" + _WORDS)
    extra = [e.lower() for e in extra]
    return hit | F.lower(name).isin(extra) if extra else hit


def sensitive_names(names: Iterable[str]) -> list[str]:
    """The sensitive ones among plain Python names, for checks made before a plan is built."""
    import re

    pattern = re.compile(_WORDS, re.IGNORECASE)
    return [n for n in names if pattern.search(n)]


def _plain(out: Column) -> Column:
    """Without ``userinfo@`` and values of sensitive parameters."""
    return F.regexp_replace(F.regexp_replace(out, _USERINFO, "//"), _QUERY_PARAM, "$1[redacted]")


def entropy(text: Column) -> Column:
    """Bits of entropy a character, from how often each character occurs in the text."""

    def bits(t: Column) -> Column:
        share = lambda c: (F.length(t) - F.length(F.replace(t, c, F.lit("")))) / F.length(t)
        chars = F.array_distinct(F.filter(F.split(t, ""), lambda c: c != ""))
        return F.aggregate(chars, F.lit(0.0), lambda sum_, c: sum_ - let(share(c), lambda p: p * F.log2(p)))

    return let(text, bits)


def looks_random(token: Column) -> Column:
    """True for a long string whose letters and digits change as those of keys do, unlike words, names and dates."""

    def judged(t: Column) -> Column:
        n = F.length(t)
        return (
            (n >= LEAST_LENGTH)
            & (F.regexp_count(t, F.lit(_TURN)) >= LEAST_TURNS * (n - 1))
            & (F.length(F.regexp_replace(t, _WORD_IN_NAME, "")) >= F.when(t.rlike("[A-Z]") & t.rlike("[a-z]"), LEAST_REST).otherwise(LEAST_REST / 2) * n)
            & (entropy(t) >= LEAST_BITS)
        )

    return let(F.regexp_replace(token, "%[0-9A-Fa-f]{2}|[^A-Za-z0-9]", ""), judged)


def credentials(texts: Column) -> Column:
    """Array of the credentials that texts (an array) hold by their form, whatever their fields are called, long ones first:
    signed tokens, key ids, private keys, long random strings."""

    def every(text: Column, pattern: str) -> Column:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def kept(candidates: Column) -> Column:
        # What has slashes or dots is looked at as a whole and part by part.
        pieces = F.flatten(F.transform(candidates, lambda t: F.when(t.rlike("[/.]"), F.array_append(F.split(t, "[/.]"), t)).otherwise(F.array(t))))
        kept = F.filter(F.array_distinct(pieces), lambda t: t.rlike(_KNOWN) | (~t.rlike(_UUID) & looks_random(t)))
        # One may be a part of another.
        ranked = F.sort_array(F.transform(kept, lambda t: F.struct(F.length(t).alias("n"), t.alias("t"))), asc=False)
        return F.when(F.size(candidates) > 0, F.transform(ranked, lambda t: t["t"])).otherwise(candidates)

    def found(text: Column) -> Column:
        inside = F.flatten(F.transform(every(text, _STRETCH), lambda t: every(t, _CANDIDATE)))
        return let(F.when(text.contains(_KEY_HEAD), F.concat(every(text, _KNOWN), inside)).otherwise(inside), kept)

    return let(F.array_join(texts, _APART), found)


def holds_form(value: Column) -> Column:
    """True when a value holds a credential by its form."""
    return F.size(credentials(F.array(value))) > 0


def mask(value: Column, found: Column) -> Column:
    """``value`` with the credentials in ``found`` replaced."""
    masked = F.aggregate(found, value, lambda out, t: F.replace(out, t, F.lit(REDACTED)))
    return F.when(F.size(found) > 0, masked).otherwise(value)


def mask_forms(value: Column) -> Column:
    """``value`` with the credentials replaced that it holds by their form."""
    return let(credentials(F.array(value)), lambda found: mask(value, found))


def _if_suspect(value: Column, clean: Callable[[Column], Column]) -> Column:
    """``clean`` for the few values that could hold a credential; the rest pass after one cheap test."""
    return F.when(value.rlike(_MARK) & value.rlike(_SUSPECT), clean(value)).otherwise(value)


def redact_url(url: Column, found: Column | None = None) -> Column:
    """Cut ``userinfo@`` and blank the values of sensitive parameters, and what ``found`` (else its own form) tells.

    If a credential is still recognisable, such as encoded JSON in a parameter, the query is dropped.
    """

    def clean(raw: Column) -> Column:
        return let(
            _plain(raw),
            lambda out: F.when(out.rlike(_ASSIGNMENT), F.regexp_replace(out, r"[?#].*$", "?[redacted]")).otherwise(out),
        )

    return _masked(_if_suspect(url, clean), found)


def scrub(value: Column, found: Column | None = None) -> Column:
    """Redact credentials written inside a value: URLs, query strings, JSON, nested pairs, and what ``found`` (else its own
    form) tells."""

    def clean(raw: Column) -> Column:
        return let(
            _plain(raw),
            lambda out: F.when(out.rlike(_ASSIGNMENT) | out.rlike(_MENTION), F.lit(REDACTED)).otherwise(out),
        )

    return _masked(_if_suspect(value, clean), found)


def _masked(value: Column, found: Column | None) -> Column:
    return let(value, lambda out: mask_forms(out)) if found is None else mask(value, found)


def texts_of(entries: Column) -> Column:
    """All names and values."""
    return F.flatten(F.transform(entries, lambda e: F.array(e["key"], e["value"])))


def redact_entries(entries: Column, extra: Iterable[str] = (), found: Column | None = None) -> Column:
    """Array of ``struct(key, value)`` with sensitive values replaced and the rest scrubbed."""

    def clean(all_: Column) -> Column:
        return F.transform(
            entries,
            lambda e: F.struct(
                scrub(e["key"], all_).alias("key"),
                F.when(is_sensitive(e["key"], extra), F.lit(REDACTED)).otherwise(scrub(e["value"], all_)).alias("value"),
            ),
        )

    return let(credentials(texts_of(entries)), clean) if found is None else clean(found)


def redact_map(m: Column, extra: Iterable[str] = ()) -> Column:
    def clean(found: Column) -> Column:
        return F.transform_values(
            m, lambda k, v: F.when(is_sensitive(k, extra), F.lit(REDACTED)).otherwise(scrub(v, found))
        )

    return let(credentials(F.map_values(m)), clean)


def names_any(entries: Column, names: Iterable[str]) -> Column:
    """True when an entry whose whole name matches one of the patterns ``names`` carries a non-blank value."""
    pattern = f"(?i)^(?:{'|'.join(names)})$"
    return F.coalesce(
        F.exists(
            entries,
            lambda e: F.trim(e["key"]).rlike(pattern) & F.coalesce(F.trim(e["value"]) != "", F.lit(False)),
        ),
        F.lit(False),
    )
