"""Java patterns of the two post tokenizers.

Loops over a group are possessive, or bounded, as Java recurses on the others and a long run of
symbols would exhaust the stack of a task.
"""

from __future__ import annotations

from marquee.functions.scalars import SPACE_CHARS, WORD

START = rf"(?<!{WORD})"  # left edge of a word
EDGE = rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"
IN_WORD = rf'[^.,?"{SPACE_CHARS}]'
NOT_WORD = r"(?:[^\p{L}\p{N}_]|\z)"

# --- Fixed values: what the raw-post tokenizer keeps whole -------------------------------------

PUNCTUATION_CHARS = r"""['"“”‘’.?!…,:;]"""
ENTITY_MARKS = r"&(?:amp|lt|gt|quot);"
GENERIC_DOMAINS = (
    "com org edu gov net mil aero asia biz cat coop info int jobs mobi museum name pro tel travel xxx"
).split()
COUNTRY_DOMAINS = tuple(
    "ac ad ae af ag ai al am an ao aq ar as at au aw ax az ba bb bd be bf bg bh bi bj bm bn bo br bs bt bv bw by bz "
    "ca cc cd cf cg ch ci ck cl cm cn co cr cs cu cv cx cy cz dd de dj dk dm do dz ec ee eg eh er es et eu "
    "fi fj fk fm fo fr ga gb gd ge gf gg gh gi gl gm gn gp gq gr gs gt gu gw gy hk hm hn hr ht hu "
    "id ie il im in io iq ir is it je jm jo jp ke kg kh ki km kn kp kr kw ky kz la lb lc li lk lr ls lt lu lv ly "
    "ma mc md me mg mh mk ml mm mn mo mp mq mr ms mt mu mv mw mx my mz na nc ne nf ng ni nl no np nr nu nz om "
    "pa pe pf pg ph pk pl pm pn pr ps pt pw py qa re ro rs ru rw sa sb sc sd se sg sh si sj sk sl sm sn so sr ss st su sv sy sz "
    "tc td tf tg th tj tk tl tm tn to tp tr tt tv tw tz ua ug uk us uy uz va vc ve vg vi vn vu wf ws ye yt za zm zw".split()
)

EYES = "[:=;]"
HAPPY = r"[D)\]}]+"
SAD = r"[(\[{]+"
TONGUE = "[pPd3]+"
OTHER_MOUTHS = r"(?:[oO]+|[/\\]+|[vV]+|[sS]+|[|]+)"
LETTER_EYE = r"0|[oO]|[vV]|[tT]|[xX]|\*"
SYMBOL_EYE = r"♥|°|\$|;|ಠ|@|ʘ|•|・|◕|\^|¬"
FACE_EYE = rf"{LETTER_EYE}|{SYMBOL_EYE}"
FACE_CENTER = r"(?:\.|[_-]+)"
EAST_LEFT = r"[＼\\ƪԄ(（<>;ヽ\-=~*]"
EAST_RIGHT = r"""[\-=);'"<>ʃ）/／ノﾉ丿╯σっµ~*]"""

TITLE = r"(?:[MmDdSsJj]r|[Mm]rs|[Mm]s|[Rr]ep|[Ss]en|[Ss]t)\."

# --- end of fixed values -----------------------------------------------------------------------


def any_of(*patterns: str) -> str:
    return "(?:" + "|".join(patterns) + ")"


def not_after(chars: str) -> str:
    """Start a run of ``chars`` at its first one (or right after the last match).

    Used where a start further inside the run could only match if the first one did, so that a long run
    is scanned once and not once per character.
    """
    return rf"(?:(?<!{chars})|\G)"


PLAIN_LETTER = r"[a-zA-Z\xC0-\xD6\xD8-\xF6\xF8-\xFF]"
PLAIN_MARK = r"[.,?!](?= |\z)"  # no other kind starts with one of them before a space


def plain_words() -> str:
    """Runs of plain words, with the space before, or one before a comma, question mark or final full stop.

    None of the kinds below can start in one, and setting off whole words changes no token, so they are
    passed over first. A space before a letter, a full stop and a letter is left, as an abbreviation may start
    with it; so are a title and www before a stop; a letter, a mark and eyes can be a face.
    """
    letter, no_dots = PLAIN_LETTER, r"(?![A-Za-z]\.[A-Za-z])"
    return (
        rf"(?: {no_dots})?+(?<![^ ])(?:(?:{letter}++ {no_dots})++"
        rf"|{letter}++(?=[,?](?!{EYES})|\z)|(?!{TITLE}|www\.){letter}++(?=\.(?: |\z)))"
    )


def _url(countries: tuple[str, ...], hosts: bool = True) -> str:
    country = any_of(*countries)
    domain = any_of(*GENERIC_DOMAINS, *countries)
    host = rf"{EDGE}[A-Za-z\p{{Nd}}-]++(?:\.[A-Za-z0-9]++){{0,3}}\.{domain}(?:\.{country})?(?={NOT_WORD})"
    begin = any_of("https?://", rf"{START}www\.", host) if hosts else "https?://"
    rest = rf"(?:[^.<>{SPACE_CHARS}][^<>{SPACE_CHARS}]*?)?"
    mark = any_of(PUNCTUATION_CHARS, ENTITY_MARKS)
    stop = any_of(
        rf"{mark}*+(?:[<>{SPACE_CHARS}]|\z)",
        rf"(?:(?!\.\.){mark})*+\.\.",
    )
    return rf"{begin}{rest}(?={stop})"


def _face(name: str) -> str:
    """Two equal eyes around a mouth, and a few fixed faces."""
    angle = any_of("<", "&lt;", ">", "&gt;")
    return any_of(
        rf"(?:(?<{name}>{FACE_EYE}){FACE_CENTER}\k<{name}>)",
        r"""--['"]""",
        rf"{angle}[._-]+{angle}",
        r"\._+\.",
    )


def _emoticon() -> str:
    mouth_end = rf"(?=\z|[^\p{{L}}\p{{N}}_]|RT|rt|Rt)"
    western = (
        rf"(?:>|&gt;)?{EYES}(?:|[^a-zA-Z0-9 ]|[oO])"
        + any_of(TONGUE + mouth_end, OTHER_MOUTHS + mouth_end, SAD, HAPPY)
    )
    reverse = (
        r"(?<![^ ])" + any_of(SAD, HAPPY, OTHER_MOUTHS) + rf"(?:|[^a-zA-Z0-9 ]){EYES}(?:<|&lt;)?"
    )
    # The body of an east-Asian face is read unit by unit, without a choice: a face that holds a character no
    # symbol is, else one symbol. It ends at its last unit before a right edge, so no unit is read again and the
    # time is in proportion to the run.
    symbol = rf"[^A-Za-z0-9()*:=\-{SPACE_CHARS}]"
    angle = any_of("<", "&lt;", ">", "&gt;")

    def unit(name: str) -> str:  # groups need names of their own
        face = any_of(
            rf"(?<l{name}>{LETTER_EYE}){FACE_CENTER}\k<l{name}>",
            rf"(?<s{name}>{SYMBOL_EYE})(?=_*-)[_-]++\k<s{name}>",
            r"""--['"]""",
            rf"[<>](?=[._]*(?:-|&))[._-]+{angle}",
            rf"&[lg]t;[._-]+{angle}",
        )
        return any_of(face, symbol)

    def body(name: str) -> str:
        return rf"(?:(?:{unit(name + 'x')}(?!{EAST_RIGHT}))*+{unit(name + 'y')}(?={EAST_RIGHT}))++"

    # the left edge takes its whole run, or else leaves the last symbol before a right edge to the body
    split = rf"{symbol}{EAST_RIGHT}"
    east = not_after(EAST_LEFT) + any_of(
        rf"{EAST_LEFT}++{body('a')}{EAST_RIGHT}++",
        rf"(?:(?:{EAST_LEFT}(?!{split}))*+{EAST_LEFT}(?={split}))++(?:{body('b')}|{symbol}){EAST_RIGHT}++",
    )
    return any_of(western, reverse, east, _face("b"), rf"[oO]{FACE_CENTER}[oO]")


def _abbreviation() -> str:
    end = any_of(r"\z", rf"[{SPACE_CHARS}]", '[“"?!,:;]', ENTITY_MARKS)
    return any_of(
        rf"(?:[A-Za-z]\.){{2,}}(?={end})",
        rf"[^A-Za-z](?:[A-Za-z]\.)+[A-Za-z](?={end})",
        rf"{START}{TITLE}",
    )


def protected_kinds(countries: tuple[str, ...] = COUNTRY_DOMAINS) -> dict[str, str]:
    """Kind to pattern, in order of priority: the leftmost match wins, then the first kind."""
    digit = r"\p{Nd}"
    return {
        "heart": r"(?:<+/?3+)++",
        "url": _url(countries),
        "email": rf"{START}[a-zA-Z0-9._%+-]++@[a-zA-Z0-9.-]+\.[a-zA-Z]{{2,4}}(?={NOT_WORD})",
        "time": rf"{not_after(digit)}{digit}++(?::{digit}++){{1,2}}",
        "thousands": r"(?:(?<!\p{Nd})\p{Nd}{1,3},)++\p{Nd}{3}(?=[^,\p{Nd}]|\z)",
        "decimal": rf"(?:\p{{Sc}}|{not_after(digit)}){digit}++(?:\.{digit}++)++%?",
        "emoticon": _emoticon(),
        "arrow": not_after("[-―—=]") + r"<*[-―—=]*>+|<+[-―—=]*>*|[\x{2190}-\x{21FF}]+",
        "entity": ENTITY_MARKS,
        "punctuation": r"""['"“”‘’]+|[.?!,…]+|[:;]+""",
        "abbreviation": _abbreviation(),
        "separator": "--+|―|—|~|–|=",
        "decoration": r"[♫♪]+|[★☆]+|[♥❤♡]+|[\x{2639}-\x{263B}]+|[\x{E001}-\x{EBBB}]+",
        "apostrophe_word": rf"{not_after(IN_WORD)}{IN_WORD}+['’′]{IN_WORD}*",
        "hashtag": "#[a-zA-Z0-9_]+",
        "mention": "[@＠][a-zA-Z0-9_]+",
    }


def protected_pattern(countries: tuple[str, ...] = COUNTRY_DOMAINS) -> str:
    """One pattern for all that stays whole."""
    return any_of(plain_words(), PLAIN_MARK, *protected_kinds(countries).values())


# A long unbroken run is read in two passes. The kinds "apostrophe_word", "email" and "url" (for a bare host) look for their
# mark to the end of a run, and would look again from each span inside it. So the first pass stops at the first character that no span starts
# with and after which the run has no apostrophe: the rest of the run, with the character before it, is one piece, which the
# second pass reads without the kinds whose marks it does not hold. Nothing is looked for twice.
LONG_RUN = "(?<![^ ])[^ ]{512}"
MARK, BEFORE_END = "\uFDD0", "\uFDD1"  # noncharacters, not for interchange
REST_FORM = f" ${{kind}} {MARK}${{before}}{BEFORE_END}${{rest}} "


def first_pass(countries: tuple[str, ...] = COUNTRY_DOMAINS) -> str:
    """A protected span as group ``kind``; or the rest of a run as ``rest``, and the character ``before`` it."""
    kinds = protected_kinds(countries)
    place = list(kinds).index("apostrophe_word")
    first, later = any_of(*list(kinds.values())[:place]), any_of(*list(kinds.values())[place:])
    before = r"(?:(?<=(?<before>[^ ]))|(?<![^ ]))"
    rest = rf"{not_after(IN_WORD)}{before}(?<rest>[^ ](?![^ '’′]*+['’′])[^ ]*+)"
    return rf"(?<kind>{first}|(?!{rest.replace('?<before>', '').replace('?<rest>', '')}){later})|{rest}"


def second_pass(without: tuple[str, ...], countries: tuple[str, ...] = COUNTRY_DOMAINS) -> str:
    """Spans of a rest of a run, some kinds (and "host": bare hosts) left out. Its first character starts no span."""
    kinds = {name: p for name, p in protected_kinds(countries).items() if name not in without}
    if "host" in without:
        kinds["url"] = _url(countries, hosts=False)
    return rf"(?!^){any_of(*kinds.values())}"


# --- Fixed values: edge punctuation and contractions -------------------------------------------

EDGE_CHARS = r"""['"“”‘’«»{}()\[\]*&]"""
OFF_EDGE = rf"[:;.,{SPACE_CHARS}]"
EDGE_LEFT = rf"(^|\z|{OFF_EDGE})({EDGE_CHARS}+)([a-zA-Z0-9])"
EDGE_RIGHT = rf"([a-zA-Z0-9])({EDGE_CHARS}+)(^|\z|{OFF_EDGE})"
CONTRACTION = rf"(?iu)({WORD}+)(n['’′]t|['’′](?:ve|ll|d|re|s|m))\z"

# --- Casual tokenizer: kinds in order of priority ----------------------------------------------

CASUAL_HANDLE = r"@(?<![A-Za-z0-9_!@#$%&*]@)(?:[A-Za-z0-9_]{20}(?!@)|[A-Za-z0-9_]{1,19}(?![A-Za-z0-9_]*@))"
CASUAL_EMOTICON = (
    r"(?:[<>]?[:;=8][\-o*']?[)\](\[dDpP/:}{@|\\]"
    r"|[)\](\[dDpP/:}{@|\\][\-o*']?[:;=8][<>]?"
    r"|<3)"
)
CASUAL_KINDS = {
    "url": rf"(?:https?://|{START}www\.)[^<>{SPACE_CHARS}]*[^<>.,;:!?'\")\]{SPACE_CHARS}]",
    "emoticon": CASUAL_EMOTICON,
    "tag": rf"<[^>{SPACE_CHARS}]+>",
    "arrow": r"-+>|<-+",
    "handle": r"@[\p{L}\p{N}_]+",
    "hashtag": r"#+[\p{L}\p{N}_][\p{L}\p{N}_'\-]*[\p{L}\p{N}_]",
    "email": r"[\p{L}\p{N}_.+\-]+@[\p{L}\p{N}_\-]+\.[\p{L}\p{N}_\-](?:\.?[\p{L}\p{N}_\-])++",
    "word": r"\p{L}[\p{L}'_\-]+\p{L}",
    "number": r"[+\-]?\p{Nd}+[,/.:\-]\p{Nd}+[+\-]?",
    "plain_word": r"[\p{L}\p{N}_]+",
    "ellipsis": rf"\.(?:[{SPACE_CHARS}]*\.)++",
    "other": rf"[^{SPACE_CHARS}]",
}
# Words, commas and full stops before a space: no earlier kind starts with one, and "word", "plain_word" or "other" would take as much.
CASUAL_PLAIN = rf"{PLAIN_LETTER}++(?=[,.]?+(?: |\z))|,|\.(?= {PLAIN_LETTER})"
CASUAL_TOKEN = rf" *+({any_of(CASUAL_PLAIN, *CASUAL_KINDS.values())})"  # group 1; no kind starts with a space
