"""Rules that take topology, credentials, quoted values and paths out of free text."""

from __future__ import annotations

from collections.abc import Sequence

from ledgerlens.functions.redaction import trimmed
from ledgerlens.functions.sqltext import lit, replace_all

# `\b` next to a word character, spelled out so that word means ASCII on every Java version.
_B = r"(?<![A-Za-z0-9_])"
_E = r"(?![A-Za-z0-9_])"

# The ordered scrub rules (pattern, replacement), each with a cheap necessary
# condition; a text without it is passed on untouched and never reaches the pattern.
TOPOLOGY_RULES = [
    (rf"(?i){_B}[a-z][a-z0-9+.-]*://[^\s'\")]+", "<url>", "contains(t, '://')"),
    (rf"(?i){_B}(password|passfile|sslpassword)\s*=\s*(\"[^\"]*\"|'[^']*'|\S+)", "$1=<redacted>", "contains(t, '=')"),
    (
        rf"(?i){_B}(user|username|role|database|dbname|host|hostaddr|address|application_name)"
        r"\s*[:=]\s*(\"[^\"]*\"|'[^']*'|\S+)",
        "$1=<redacted>",
        "contains(t, '=') OR contains(t, ':')",
    ),
    (
        rf"(?i){_B}(user|username|role|database|dbname|host|hostname|address)\s+(\"[^\"]*\"|'[^']*')",
        "$1 <redacted>",
        f"contains(t, '\"') OR contains(t, {lit(chr(39))})",
    ),
    (
        rf"(?i){_B}(for|by|on)\s+(user|role|database|dbname)\s+(\"[^\"]*\"|'[^']*'|[^\s,;]+)",
        "$1 $2 <redacted>",
        f"t RLIKE {lit('[uUrRdD](?:(?i)ser|ole|atabase|bname)')}",
    ),
    (r"\[\s*[0-9A-Fa-f:.]+\s*\](?::\d{1,5})?", "<host>", "contains(t, '[')"),
    (
        rf"\d(?<![A-Za-z0-9_]\d)\d{{0,2}}(?:\.\d{{1,3}}){{3}}(?::\d{{1,5}})?{_E}",
        "<host>",
        f"t RLIKE {lit(r'[0-9][.][0-9]')}",
    ),
    (rf":\d{{2,5}}{_E}", ":<port>", "contains(t, ':')"),
    (r"(^|[\s\"'(=:])(?:/[A-Za-z0-9._+-]+){2,}", "$1<path>", "contains(t, '/')"),
    (
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "<email>",
        "contains(t, '@')",
    ),
    (rf"{_B}[A-Za-z0-9][A-Za-z0-9.-]*\.[A-Za-z][A-Za-z0-9-]*:\d{{1,5}}{_E}", "<host>", f"t RLIKE {lit(':[0-9]')}"),
    (r"[ \t]{2,}", " ", "contains(t, '  ') OR contains(t, '\t')"),
]

#: Exact terms shorter than this would match inside ordinary words.
MIN_TERM = 3


def replace_terms(x: str, terms: Sequence[str], replacement: str) -> str:
    for term in terms:
        x = f"replace({x}, {lit(term)}, {lit(replacement)})"
    return x


def scrub_steps(x: str, terms: Sequence[str] = ()) -> list[str]:
    """The scrub as a list of expressions: the first over ``x``, every other over ``t``, the result
    of the one before."""
    exact = sorted((term for term in terms if len(term) >= MIN_TERM), key=len, reverse=True)
    steps = [f"coalesce({replace_terms(x, exact, '<redacted>')}, '')"]
    for pattern, replacement, needed in TOPOLOGY_RULES:
        steps.append(f"CASE WHEN {needed} THEN regexp_replace(t, {lit(pattern)}, {lit(replacement)}) ELSE t END")
    return [*steps, trimmed("t")]


def scrub(x: str, terms: Sequence[str] = ()) -> str:
    """Exact terms, longest first, then the ordered rules, then blanks collapsed, as one expression."""
    first, *steps = scrub_steps(x, terms)
    arms = " ".join(f"WHEN {i} THEN {step}" for i, step in enumerate(steps))
    return f"aggregate(sequence(0, {len(steps) - 1}), {first}, (t, i) -> CASE i {arms} END)"


def mask_credentials(x: str, secrets: Sequence[str] = ()) -> str:
    masked = replace_all(x, [(r"([a-zA-Z][a-zA-Z0-9+.-]*://[^:@/\s]*:)[^@/\s]*@", "$1***@")])
    return replace_terms(masked, [s for s in secrets if s], "***")


# Length caps of a stored error record.
MESSAGE_CHARS = 500
STACK_CHARS = 2000

_SEGMENT = r"[A-Za-z0-9_.~+@-]+"
_POSIX = rf"(?:/{_SEGMENT}){{2,}}/?"
_WINDOWS = r"[A-Za-z]:\\(?:[^\\\s\"'|,;]+\\)*[^\\\s\"'|,;]*"
_QUOTED_RULES = [
    (r"=\(([^)]*)\)", "=(?)"),
    (r"\"(?:[^\"\\\n]|\\.)*+\"", '"?"'),
    (r"'[^']*+(?:''[^']*+)*+'", "'?'"),
]


def _rewrite(x: str, pattern: str, probe: str, each: str) -> str:
    """Apply ``each`` (an expression over ``p``) to every match; rows without ``probe`` skip it."""
    # what lies between two matches is one piece, however long
    pieces = f"regexp_extract_all({x}, {lit(rf'{pattern}|(?:(?!{pattern})[\s\S])++')}, 0)"
    joined = f"array_join(transform({pieces}, p -> CASE WHEN p RLIKE {lit(rf'^(?:{pattern})$')} THEN {each} ELSE p END), '')"
    return f"CASE WHEN {x} RLIKE {lit(probe)} THEN {joined} ELSE {x} END"


def _shorten_windows(p: str) -> str:
    parts = f"filter(split({p}, {lit(chr(92) * 2)}), s -> s <> '')"
    return (
        f"concat('<path>/', CASE WHEN size({parts}) <= 2 THEN element_at({parts}, -1) "
        f"ELSE array_join(slice({parts}, -2, 2), '/') END)"
    )


def _shorten_posix(p: str, homes: Sequence[str]) -> str:
    parts = f"filter(split({p}, '/'), s -> s <> '')"
    arms = ""
    for home in homes:
        bare = home.rstrip("/")
        arms += f"WHEN {p} = {lit(bare)} THEN '~' "
        arms += f"WHEN startswith({p}, {lit(bare + '/')}) THEN concat('~/', substring({p}, {len(bare) + 2})) "
    return (
        f"CASE {arms}WHEN instr({p}, '/node_modules/') > 0 "
        f"THEN concat('node_modules/', element_at(split({p}, '/node_modules/'), -1)) "
        f"ELSE concat('<path>/', array_join(slice({parts}, -2, 2), '/')) END"
    )


def scrub_error_values(x: str) -> str:
    """Key details and quoted spans of an error text replaced."""
    return replace_all(x, _QUOTED_RULES)


def shorten_windows_paths(x: str) -> str:
    return _rewrite(x, _WINDOWS, r"[A-Za-z]:\\", _shorten_windows("p"))


def shorten_posix_paths(x: str, homes: Sequence[str] = ()) -> str:
    return _rewrite(x, _POSIX, rf"/{_SEGMENT}/", _shorten_posix("p", homes))


def clamp(x: str, limit: int) -> str:
    return f"CASE WHEN char_length({x}) > {limit} THEN concat(left({x}, {limit}), '…') ELSE {x} END"
