"""Statement redaction, fingerprints and previews as native expressions.

Each function takes the SQL text of a string expression and returns the SQL text of the result,
so the same definition serves ``F.expr`` and ``CREATE FUNCTION``. All patterns are linear-time:
quantified groups are possessive, which Java's matcher also runs without recursion, so a literal
of a megabyte is one pass and no stack.
"""

from __future__ import annotations

from collections.abc import Callable

from ledgerlens.functions.mac import hmac_sha256
from ledgerlens.functions.sqltext import lit, replace_all, utf16_length

# The marker, caps and truncation sign of the record format.
UNREDACTABLE = "/* unredactable */"
MAX_SCAN_BYTES = 1_048_576
PREVIEW_CHARS = 200
PREVIEW_BYTES = 512
ELLIPSIS = "…"

#: what trimming removes
BLANKS = " \t\n\r\f\v\u00a0\ufeff\u2028\u2029"

#: Nested block comments of this depth are matched by the patterns; deeper ones are found by a fold first.
COMMENT_DEPTH = 8

def _block_comment(depth: int) -> str:
    pattern = r"/\*(?:[^*/]++|\*(?!/)|/(?!\*))*+\*/"
    for _ in range(depth - 1):
        pattern = rf"/\*(?:[^*/]++|\*(?!/)|/(?!\*)|{pattern})*+\*/"
    return pattern


def _quoted(quote: str, escapes: bool) -> str:
    if escapes:
        return rf"[^{quote}\\]*+(?:(?:\\[\s\S]|{quote}{quote})[^{quote}\\]*+)*+"
    return rf"[^{quote}]*+(?:{quote}{quote}[^{quote}]*+)*+"


_COMMENT = rf"--[^\n]*+|{_block_comment(COMMENT_DEPTH)}"
_DOLLAR_OPEN = r"\$(?:[A-Za-z_][A-Za-z0-9_]*+)?\$"
# Whether a quote opens an escaping form is read off what stands before it, so ordinary text can
# be skipped in runs. A quote opens exactly one form; an unterminated one has no second reading.
_AFTER_E = r"(?<![A-Za-z0-9_$])[Ee]"
_AFTER_U = r"(?<![A-Za-z0-9_$])[Uu]&"
_LITERALS = [
    (rf"'(?<={_AFTER_E}')", _quoted("'", True), "'"),
    (rf"'(?<={_AFTER_U}')", _quoted("'", True), "'"),
    (rf"'(?<!{_AFTER_E}')(?<!{_AFTER_U}')", _quoted("'", False), "'"),
    (rf"\"(?<={_AFTER_U}\")", _quoted('"', True), '"'),
    (rf"\"(?<!{_AFTER_U}\")", _quoted('"', False), '"'),
]


def _token_pattern() -> str:
    """Comment, or literal with its opening delimiter in group 1, 3, 5.. and closing in 2, 4, 6.."""
    parts = [_COMMENT]
    for opening, body, close in _LITERALS:
        parts.append(rf"({opening}){body}({close})")
    dollar = 2 * len(_LITERALS) + 1
    parts.append(rf"({_DOLLAR_OPEN})[\s\S]*?(\{dollar})")
    # one look at the character rules out every alternative at most positions
    return rf"(?=[-/'\"$])(?:{'|'.join(parts)})"


_TOKEN = _token_pattern()
_GROUPS = "".join(f"${n}" for n in range(1, 13, 2)), "".join(f"${n}" for n in range(2, 13, 2))


def _complete_pattern() -> str:
    """Matches exactly the statements whose every delimiter is accounted for."""
    literals = "|".join(rf"{o}{b}{c}" for o, b, c in _LITERALS)
    return (
        rf"\A(?:[^'\"$/\-]++|{literals}|{_COMMENT}|({_DOLLAR_OPEN})[\s\S]*?\1"
        r"|-(?!-)|/(?!\*)|\$(?!(?:[A-Za-z_][A-Za-z0-9_]*+)?\$))*+\z"
    )


_COMPLETE = _complete_pattern()

# NUL cannot occur in statement text, so three of them can stand for "a comment was here" and
# one for "a body was here" until the last step.
_MARK = "\0"

_NUMBERS = [
    # a number of two or more characters, never glued to a name or placeholder
    (
        r"[0-9](?<![A-Za-z0-9_$][0-9])(?=[0-9.]|[eE][+-]?[0-9])"
        r"[0-9]*+(?:\.[0-9]*+)?+(?:[eE][+-]?[0-9]++)?+(?![A-Za-z0-9_$])",
        "?",
    ),
    # one digit where a value is expected: after an operator, parenthesis or comma
    (
        r"((?:[=<>!~@|&?*+\-/%^:,.(\[;]|(?!\A)\G)[ \t\n\r]*+)"
        r"(?<![A-Za-z0-9_$])[0-9](?![A-Za-z0-9_$.])",
        "$1?",
    ),
]
_KEY_DETAIL = (r"=\(([^)]*)\)", "= (?)")


def is_readable(x: str) -> str:
    """True when every literal and comment of the statement is terminated and the size is scanned."""
    return (
        f"({x} IS NOT NULL AND octet_length({x}) <= {MAX_SCAN_BYTES} AND instr({x}, {lit(_MARK)}) = 0 "
        f"AND {x} RLIKE {lit(_COMPLETE)})"
    )


#: a special character, or a run of others
_CHARACTERS = r"[^'\"$/*\\\-]++|[\s\S]"


def _block_comments(x: str) -> str:
    """Array of the (first, after) positions of the block comments of a statement, nested to any depth; null when a literal or comment does not end.

    A fold over the special characters that knows where it is: in text, in a literal (``mode`` is its quote) or in a comment. What
    is looked up in the statement itself is passed over up to ``skip``.
    """
    introduced = (
        f"CASE t WHEN {lit(chr(39))} THEN rlike(substring({x}, greatest(1, s.at - 3), least(3, s.at - 1)), {lit(r'(?:^|[^A-Za-z0-9_$])(?:[Ee]|[Uu]&)$')}) "
        f"ELSE rlike(substring({x}, greatest(1, s.at - 3), least(3, s.at - 1)), {lit(r'(?:^|[^A-Za-z0-9_$])[Uu]&$')}) END"
    )
    tag = f"substring({x}, s.at, locate('$', {x}, s.at + 1) - s.at + 1)"
    tagged = f"(locate('$', {x}, s.at + 1) > 0 AND {tag} RLIKE {lit(f'^{_DOLLAR_OPEN}$')})"
    line_end = f"CASE WHEN locate({lit(chr(10))}, {x}, s.at) > 0 THEN locate({lit(chr(10))}, {x}, s.at) ELSE char_length({x}) + 1 END"
    # what a character does
    does = (
        "CASE WHEN s.at < s.skip THEN 'pass' "
        "WHEN s.mode = 'c' THEN CASE WHEN s.prev = '/' AND t = '*' THEN 'deeper' WHEN s.prev = '*' AND t = '/' THEN 'higher' ELSE 'look' END "
        "WHEN s.mode <> '' AND NOT (s.quote AND t <> s.mode) THEN "
        "CASE WHEN s.quote THEN 'double' WHEN s.back THEN 'escaped' WHEN s.escapes AND t = chr(92) THEN 'back' WHEN t = s.mode THEN 'quote' ELSE 'pass' END "
        "WHEN s.mode = '' AND s.prev = '/' AND t = '*' THEN 'comment' WHEN s.mode = '' AND s.prev = '-' AND t = '-' THEN 'line' "
        f"WHEN t IN ({lit(chr(39))}, {lit(chr(34))}) THEN 'open' WHEN t = '$' AND {tagged} THEN 'dollar' ELSE 'text' END"
    )
    step = {
        "at": "s.at + char_length(t)",
        "mode": "CASE WHEN d = 'comment' THEN 'c' WHEN d = 'open' THEN t WHEN d IN ('line', 'dollar', 'text') OR (d = 'higher' AND s.depth = 1) THEN '' ELSE s.mode END",
        "escapes": f"CASE WHEN d = 'open' THEN {introduced} ELSE s.escapes END",
        "back": "d = 'back'",
        "quote": "CASE WHEN d = 'quote' THEN true WHEN d IN ('double', 'open', 'line', 'dollar', 'text', 'comment') THEN false ELSE s.quote END",
        "prev": "CASE WHEN d IN ('look', 'text') AND t IN ('/', '*', '-') THEN t WHEN d = 'pass' THEN s.prev ELSE '' END",
        "depth": "CASE d WHEN 'comment' THEN 1 WHEN 'deeper' THEN s.depth + 1 WHEN 'higher' THEN s.depth - 1 ELSE s.depth END",
        "since": "CASE WHEN d = 'comment' THEN s.at - 1 ELSE s.since END",
        "skip": f"CASE d WHEN 'line' THEN {line_end} WHEN 'dollar' THEN locate({tag}, {x}, s.at + char_length({tag})) + char_length({tag}) ELSE s.skip END",
        "open": f"s.open OR (d = 'dollar' AND locate({tag}, {x}, s.at + char_length({tag})) = 0)",
        "found": "CASE WHEN d = 'higher' AND s.depth = 1 THEN concat(s.found, array(named_struct('first', s.since, 'after', s.at + 1))) ELSE s.found END",
    }
    begin = {
        "at": "1", "mode": "''", "escapes": "false", "back": "false", "quote": "false", "prev": "''", "depth": "0", "since": "0", "skip": "0", "open": "false",
        "found": "CAST(array() AS array<struct<first: int, after: int>>)",
    }
    start, after = (f"named_struct({', '.join(f'{lit(k)}, {v}' for k, v in fields.items())})" for fields in (begin, step))
    return (
        f"aggregate(regexp_extract_all({x}, {lit(_CHARACTERS)}, 0), {start}, (s, t) -> transform(array({does}), d -> {after})[0], "
        "s -> CASE WHEN NOT s.open AND (s.mode = '' OR s.quote) THEN s.found END)"
    )


def _flat(x: str) -> str:
    """The statement with an empty comment in place of each block comment; null when a literal or comment does not end."""
    piece = (
        f"substring({x}, CASE WHEN i = 0 THEN 1 ELSE r[i - 1].after END, CASE WHEN i = size(r) THEN char_length({x}) + 1 ELSE r[i].first END - "
        "CASE WHEN i = 0 THEN 1 ELSE r[i - 1].after END)"
    )
    return f"transform(array({_block_comments(x)}), r -> array_join(transform(sequence(0, size(r)), i -> {piece}), '/**/'))[0]"


def of_readable(x: str, text: Callable[[str], str], otherwise: str = lit(UNREDACTABLE)) -> str:
    """``text`` of a readable statement, ``otherwise`` of any other. A statement that the patterns cannot read may hold comments nested
    deeper than they go; these are emptied first."""
    deep = f"transform(array({_flat(x)}), f -> CASE WHEN {is_readable('f')} THEN {text('f')} ELSE {otherwise} END)[0]"
    scanned = f"coalesce(contains({x}, '/*') AND octet_length({x}) <= {MAX_SCAN_BYTES}, false)"
    return f"CASE WHEN {is_readable(x)} THEN {text(x)} WHEN {scanned} THEN {deep} ELSE {otherwise} END"


def strip_literals(x: str) -> str:
    """Comments removed and literal bodies replaced by ``?``; delimiters stay."""
    marked = f"regexp_replace({x}, {lit(_TOKEN)}, {lit(_GROUPS[0] + _MARK + _GROUPS[1] + _MARK * 2)})"
    without_comments = f"replace(replace({marked}, {lit(_MARK * 3)}, ''), {lit(_MARK * 2)}, '')"
    return f"replace({without_comments}, {lit(_MARK)}, '?')"


def redact_numbers(x: str) -> str:
    return replace_all(x, _NUMBERS)


def redact(x: str) -> str:
    """Statement text with every data-bearing part replaced, or the fixed marker."""
    return of_readable(x, lambda t: replace_all(redact_numbers(strip_literals(t)), [_KEY_DETAIL]))


def _keep_identifiers(x: str, salt: str) -> str:
    """Like :func:`strip_literals`, but a quoted identifier becomes a keyed digest of its body."""
    piece = rf"{_TOKEN}|[^'\"$/\-]++|[\s\S]"
    digest = hmac_sha256("substring(t, 2, char_length(t) - 2)", salt.encode())
    quote, mark = lit('"'), lit(_MARK)
    each = (
        "CASE WHEN char_length(t) = 1 THEN t "
        f"WHEN startswith(t, {quote}) THEN concat({quote}, {lit(_MARK + 'x')}, substring({digest}, 1, 16), {mark}, {quote}) "
        f"WHEN startswith(t, {lit(chr(39))}) THEN {lit(chr(39) + '?' + chr(39))} "
        "WHEN startswith(t, '--') OR startswith(t, '/*') THEN '' "
        f"WHEN startswith(t, '$') THEN regexp_replace(t, {lit(rf'^({_DOLLAR_OPEN})[\s\S]*+$')}, '$1?$1') ELSE t END"
    )
    joined = f"array_join(transform(regexp_extract_all({x}, {lit(piece)}, 0), t -> {each}), '')"
    # the introducer of an escaped identifier is not part of its identity
    return f"regexp_replace({joined}, {lit(_AFTER_U + '(?=\"' + chr(92) + 'x00x)')}, '')"


def normalise(x: str, salt: str) -> str:
    """The text a fingerprint is taken of."""
    def stripped(t: str) -> str:
        return redact_numbers(f"CASE WHEN instr({t}, '\"') > 0 THEN {_keep_identifiers(t, salt)} ELSE {strip_literals(t)} END")

    text = of_readable(x, stripped)
    return f"trim(regexp_replace(regexp_replace(lower({text}), {lit(r'\s{2,}+|[\t\n\r\f\x0b]')}, ' '), {lit(r';\s*$')}, ''))"


def fingerprint(x: str, salt: str = "ledgerlens") -> str:
    """16 hex digits naming "the same statement, whatever values were passed"."""
    return f"substring(sha2({normalise(x, salt)}, 256), 1, 16)"


def clip(x: str, chars: int = PREVIEW_CHARS, size: int = PREVIEW_BYTES) -> str:
    """The longest prefix within both caps; a character is never split."""
    n = f"left({x}, n)"
    longest = (
        f"array_max(filter(sequence(0, {chars}), n -> {utf16_length(n)} <= {chars} AND octet_length({n}) <= {size}))"
    )
    return (
        f"CASE WHEN octet_length({x}) <= {chars} THEN {x} "
        f"WHEN octet_length(left({x}, {chars})) <= {chars} THEN left({x}, {chars}) "
        f"ELSE left({x}, {longest}) END"
    )


def preview(redacted: str, **caps) -> str:
    """A capped preview of already redacted text (see :func:`trimmed`)."""
    clipped = clip(redacted, **caps)
    return (
        f"CASE WHEN {redacted} = {lit(UNREDACTABLE)} THEN {redacted} "
        f"WHEN char_length({clipped}) = char_length({redacted}) THEN {redacted} "
        f"ELSE concat({clipped}, {lit(ELLIPSIS)}) END"
    )


def trimmed(x: str) -> str:
    return f"trim(BOTH {lit(BLANKS)} FROM {x})"


def statement_hash(statements: str) -> str:
    """Hash of an array of statements: trimmed, blanks collapsed, lower case, length-prefixed."""
    flat = f"lower(regexp_replace({trimmed('s')}, {lit(r'\s+')}, ' '))"
    each = f"concat({utf16_length(flat)}, ':', {flat})"
    return f"sha2(array_join(transform({statements}, s -> {each}), '|'), 256)"
