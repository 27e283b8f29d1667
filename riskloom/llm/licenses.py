"""License scan by ordered signature rules, with DataFrame functions only.

Rules are regular expressions over the text with A-Z lower-cased. Each has a keyword; a rule runs only on texts that hold
its keyword (white space of any kind and length taken as one blank), and a text without any keyword is not searched at
all. Where detections overlap, one that lies inside the interval of a detection of higher priority, or of equal priority
and greater length, is suppressed.

The rules of a license come from its row in ``TITLES``: its name in prose, an identifier tag, a notice ("released under
..."), its address. Fixed phrases, found as consecutive words, are reported apart with their word positions and always
keep their labels.

Everything happens within a row: no shuffle, no join. Suppression compares the detections of one text with one another.

Defined cases: a NULL text is empty; an empty text has no word and no label and score 0; ties between equal intervals of
equal priority go to the first rule; repeated rows are each scanned; empty tables give no rows; further columns are
ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.text import literal
from riskloom.llm.common import lower_ascii, table, whole_text

# The phrases that are always counted, and their labels.
PHRASES = {
    "cc-by": ("cc", "by"),
    "gpl": ("general", "public", "license"),
    "reserved": ("all", "rights", "reserved"),
}
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# label, keyword, name in prose, identifier, address. Names match with any white space between their words.
TITLES = (
    ("apache-1.1", "apache", r"apache (software )?licen[sc]e,? (version |v\.? ?)?1\.1", r"apache-1\.1", r"apache\.org/licenses/license-1\.1"),
    ("apache-2.0", "apache", r"apache (software )?licen[sc]e,? (version |v\.? ?)?2(\.0)?", r"apache-2\.0", r"apache\.org/licenses/license-2\.0"),
    ("mit", "mit licen", r"(the )?mit licen[sc]e", r"mit", r"opensource\.org/licen[sc]es?/mit"),
    ("mit-0", "mit no ", r"mit no attribution", r"mit-0", r"opensource\.org/licen[sc]es?/mit-0"),
    ("bsd-2-clause", "bsd", r"(simplified|freebsd|2-clause) bsd licen[sc]e|bsd 2-clause( licen[sc]e)?", r"bsd-2-clause", r"opensource\.org/licen[sc]es?/bsd-2-clause"),
    ("bsd-3-clause", "bsd", r"(new|modified|revised|3-clause) bsd licen[sc]e|bsd 3-clause( licen[sc]e)?", r"bsd-3-clause", r"opensource\.org/licen[sc]es?/bsd-3-clause"),
    ("bsd-4-clause", "bsd", r"(original|4-clause) bsd licen[sc]e|bsd 4-clause( licen[sc]e)?", r"bsd-4-clause", r"spdx\.org/licenses/bsd-4-clause"),
    ("0bsd", "bsd", r"(zero-clause|0-clause) bsd( licen[sc]e)?|bsd zero clause licen[sc]e", r"0bsd", r"opensource\.org/licen[sc]es?/0bsd"),
    ("gpl-1.0", "general public", r"general public licen[sc]e,? (version |v\.? ?)?1(\.0)?", r"gpl-1\.0(-only|-or-later|\+)?", r"gnu\.org/licenses/old-licenses/gpl-1\.0"),
    ("gpl-2.0", "general public", r"general public licen[sc]e,? (version |v\.? ?)?2(\.0)?", r"gpl-2\.0(-only|-or-later|\+)?", r"gnu\.org/licenses/old-licenses/gpl-2\.0"),
    ("gpl-3.0", "general public", r"general public licen[sc]e,? (version |v\.? ?)?3(\.0)?", r"gpl-3\.0(-only|-or-later|\+)?", r"gnu\.org/licenses/gpl(-3\.0)?"),
    ("lgpl-2.1", "general public", r"(lesser|library) general public licen[sc]e,? (version |v\.? ?)?2\.[01]", r"lgpl-2\.[01](-only|-or-later|\+)?", r"gnu\.org/licenses/old-licenses/lgpl-2\.[01]"),
    ("lgpl-3.0", "general public", r"lesser general public licen[sc]e,? (version |v\.? ?)?3(\.0)?", r"lgpl-3\.0(-only|-or-later|\+)?", r"gnu\.org/licenses/lgpl(-3\.0)?"),
    ("agpl-3.0", "general public", r"affero general public licen[sc]e(,? (version |v\.? ?)?3(\.0)?)?", r"agpl-3\.0(-only|-or-later|\+)?", r"gnu\.org/licenses/agpl(-3\.0)?"),
    ("gfdl", "free documentation", r"(gnu )?free documentation licen[sc]e(,? (version |v\.? ?)?1\.[123])?", r"gfdl-1\.[123](-only|-or-later)?", r"gnu\.org/licenses/fdl(-1\.3)?"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[sc]e,? (version |v\.? ?)?1\.[01]", r"mpl-1\.[01]", r"mozilla\.org/mpl/(mpl-)?1\.[01]"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[sc]e,? (version |v\.? ?)?2(\.0)?", r"mpl-2\.0", r"mozilla\.org/(en-us/)?mpl/2\.0"),
    ("epl-1.0", "eclipse", r"eclipse public licen[sc]e( -)?,? (version |v\.? ?)?1(\.0)?", r"epl-1\.0", r"eclipse\.org/legal/epl-v10"),
    ("epl-2.0", "eclipse", r"eclipse public licen[sc]e( -)?,? (version |v\.? ?)?2(\.0)?", r"epl-2\.0", r"eclipse\.org/legal/epl-(v20|2\.0)"),
    ("cddl-1.0", "common development", r"common development and distribution licen[sc]e(,? (version |v\.? ?)?1(\.[01])?)?", r"cddl-1\.[01]", r"opensource\.org/licen[sc]es?/cddl-1\.0"),
    ("cpl-1.0", "common public", r"common public licen[sc]e(,? (version |v\.? ?)?1(\.0)?)?", r"cpl-1\.0", r"opensource\.org/licen[sc]es?/cpl-?1\.0"),
    ("isc", "isc licen", r"(the )?isc licen[sc]e", r"isc", r"opensource\.org/licen[sc]es?/isc"),
    ("zlib", "zlib", r"(the )?zlib(/libpng)? licen[sc]e", r"zlib", r"zlib\.net/zlib_license"),
    ("libpng", "libpng", r"(the )?libpng licen[sc]e", r"libpng(-2\.0)?", r"libpng\.org/pub/png/src/libpng-license"),
    ("bsl-1.0", "boost", r"boost software licen[sc]e( -)?(,? (version |v\.? ?)?1(\.0)?)?", r"bsl-1\.0", r"boost\.org/license_1_0"),
    ("artistic-1.0", "artistic", r"artistic licen[sc]e,? (version |v\.? ?)?1(\.0)?", r"artistic-1\.0", r"opensource\.org/licen[sc]es?/artistic-1\.0"),
    ("artistic-2.0", "artistic", r"artistic licen[sc]e,? (version |v\.? ?)?2(\.0)?", r"artistic-2\.0", r"opensource\.org/licen[sc]es?/artistic-2\.0"),
    ("unlicense", "unlicense", r"the unlicense", r"unlicense", r"unlicense\.org"),
    ("wtfpl", "want to", r"do what the f\S+ you want to public licen[sc]e", r"wtfpl", r"wtfpl\.net"),
    ("ofl-1.1", "open font", r"(sil )?open font licen[sc]e(,? (version |v\.? ?)?1\.[01])?", r"ofl-1\.[01]", r"scripts\.sil\.org/ofl"),
    ("ms-pl", "microsoft", r"microsoft public licen[sc]e", r"ms-pl", r"opensource\.org/licen[sc]es?/ms-pl"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[sc]e", r"ms-rl", r"opensource\.org/licen[sc]es?/ms-rl"),
    ("eupl-1.2", "european union public", r"european union public licen[sc]e(,? (version |v\.? ?)?1\.[012])?", r"eupl-1\.[012]", r"joinup\.ec\.europa\.eu/\S*eupl"),
    ("odbl-1.0", "open database", r"open database licen[sc]e(,? (version |v\.? ?)?1(\.0)?)?", r"odbl-1\.0", r"opendatacommons\.org/licenses/odbl"),
    ("odc-by-1.0", "open data commons", r"open data commons attribution licen[sc]e(,? (version |v\.? ?)?1(\.0)?)?", r"odc-by-1\.0", r"opendatacommons\.org/licenses/by"),
    ("pddl-1.0", "public domain dedication", r"public domain dedication and licen[sc]e(,? (version |v\.? ?)?1(\.0)?)?", r"pddl-1\.0", r"opendatacommons\.org/licenses/pddl"),
    ("python-2.0", "python", r"python software foundation licen[sc]e(,? (version |v\.? ?)?2(\.0)?)?|psf licen[sc]e", r"(python|psf)-2\.0", r"docs\.python\.org/\S*license"),
    ("php-3.01", "php licen", r"(the )?php licen[sc]e(,? (version |v\.? ?)?3\.0?1)?", r"php-3\.01", r"php\.net/license"),
    ("postgresql", "postgresql", r"(the )?postgresql licen[sc]e", r"postgresql", r"postgresql\.org/about/licence"),
    ("ruby", "ruby licen", r"(the )?ruby licen[sc]e", r"ruby", r"ruby-lang\.org/\S*license"),
    ("upl-1.0", "universal permissive", r"universal permissive licen[sc]e(,? (version |v\.? ?)?1(\.0)?)?", r"upl-1\.0", r"oss\.oracle\.com/licenses/upl"),
    ("busl-1.1", "business source", r"business source licen[sc]e(,? (version |v\.? ?)?1\.1)?", r"busl-1\.1", r"mariadb\.com/bsl11"),
    ("sspl-1.0", "server side", r"server side public licen[sc]e(,? (version |v\.? ?)?1(\.0)?)?", r"sspl-1\.0", r"mongodb\.com/licensing/server-side-public-license"),
    ("elastic-2.0", "elastic", r"elastic licen[sc]e(,? (version |v\.? ?)?2(\.0)?)?", r"elastic-2\.0", r"elastic\.co/licensing/elastic-license"),
    ("openssl", "openssl", r"(the )?openssl licen[sc]e", r"openssl", r"openssl\.org/source/license"),
    ("ncsa", "illinois", r"(university of illinois|uiuc)(/ncsa)? open source licen[sc]e", r"ncsa", r"opensource\.org/licen[sc]es?/(uoi-)?ncsa"),
)
# Creative Commons licenses: elements, and the versions their names and addresses carry.
CC_ELEMENTS = {
    "by": "attribution",
    "by-sa": "attribution[- ]share ?-?alike",
    "by-nd": "attribution[- ]no ?derivat(ive|e)s?( works)?",
    "by-nc": "attribution[- ]non-?commercial",
    "by-nc-sa": "attribution[- ]non-?commercial[- ]share ?-?alike",
    "by-nc-nd": "attribution[- ]non-?commercial[- ]no ?derivat(ive|e)s?( works)?",
}
# label, keyword, expression, priority: notices that name no single license. <b> and <e>: the borders of a word.
NOTICES = (
    ("cc0-1.0", "cc0", r"<b>cc0( 1\.0)?( universal)?<e>", 2),
    ("cc0-1.0", "creativecommons", r"creativecommons\.org/publicdomain/zero/1\.0", 3),
    ("public-domain", "public domain", r"(released|placed|dedicated|is) (in|into|to) the public domain", 2),
    ("public-domain", "creativecommons", r"creativecommons\.org/publicdomain/mark/1\.0", 3),
    ("gpl", "general public", r"(gnu )?general public licen[sc]e", 1),
    ("gpl", "gpl", r"<b>(gnu )?gpl( licen[sc]ed)?<e>", 1),
    ("lgpl", "lgpl", r"<b>(gnu )?lgpl<e>", 1),
    ("bsd", "bsd", r"<b>bsd( style)? licen[sc]e<e>", 1),
    ("apache", "apache", r"<b>apache licen[sc]e<e>", 1),
    ("mpl", "mozilla", r"mozilla public licen[sc]e", 1),
    ("artistic", "artistic", r"<b>artistic licen[sc]e<e>", 1),
    ("cc", "creative commons", r"creative commons licen[sc]e", 1),
    ("proprietary", "proprietary", r"proprietary (and confidential|licen[sc]e|software)", 2),
    ("proprietary", "confidential", r"(strictly )?confidential (and|information)", 1),
    ("reserved", "reserved", r"all rights( are)? reserved", 2),
    ("reserved", "reproduc", r"(may|must) not be (reproduced|copied|distributed) without", 2),
    ("copyright", "copyright", r"copyright( \(c\)| ©)? ?(19|20)\d\d", 1),
    ("permission-notice", "permission", r"permission is hereby granted,? free of charge", 2),
    ("permission-notice", "permission", r"permission to use, copy, modify,? and(/or)? distribute", 2),
    ("warranty-notice", "warrant", r"without warrant(y|ies)( or conditions)? of any kind", 1),
    ("redistribution-notice", "redistribution", r"redistribution and use in source and binary forms", 2),
)
TAG, ADDRESS, NOTICE, NAME, MENTION = 5, 4, 3, 2, 1
#: How sure a detection of each priority is.
CONFIDENCE = {TAG: 1.0, ADDRESS: 0.95, NOTICE: 0.9, NAME: 0.8, MENTION: 0.5}
PHRASE_CONFIDENCE = 0.8


# Word borders of lower-cased text, written out: what a border is beyond ASCII depends on the JVM.
BEGIN, END = "(?<![0-9a-z_])", "(?![0-9a-z_])"


_DETECTION = "rule: int, label: string, priority: int, start: int, end: int"
#: Items of an array that are gone through at a time.
ITEMS = 256


class Rule(NamedTuple):
    label: str
    keyword: str
    expression: str
    priority: int


def _spaced(expression: str) -> str:
    return expression.replace(" ", r"\s+") if r"\s" not in expression else expression


def rules() -> list[Rule]:
    """All rules in order."""
    under = r"(licen[sc]ed|released|distributed|available|published|provided|covered) (under|by) (the )?(terms of )?(the )?"
    out: list[Rule] = []
    for label, keyword, name, tag, address in TITLES:
        host = address.split("\\.")[0].split("/")[-1].split("(")[0]
        out += [
            Rule(label, "spdx", rf"spdx-license-identifier:\s*{tag}(?![\w.-])", TAG),
            Rule(label, f"{host}.", rf"(https?://)?(www\.)?{address}", ADDRESS),
            Rule(label, keyword, _spaced(rf"{under}(gnu )?({name})(?!\.?\w)"), NOTICE),
            Rule(label, keyword, _spaced(rf"<b>(gnu )?({name})(?!\.?\w)"), NAME),
        ]
    for elements, name in CC_ELEMENTS.items():
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            label, v = f"cc-{elements}-{version}", version.replace(".", r"\.")
            out += [
                Rule(label, "spdx", rf"spdx-license-identifier:\s*{label.replace('.', chr(92) + '.')}(?![\w.-])", TAG),
                Rule(label, "creativecommons", rf"(https?://)?(www\.)?creativecommons\.org/licenses/{elements}/{v}", ADDRESS),
                Rule(label, "creative commons", _spaced(rf"creative commons {name} {v}"), NAME),
                Rule(label, "cc", rf"<b>cc[ -]{elements}[ -]{v}(?!\.?\w)", NAME),
            ]
        out.append(Rule(f"cc-{elements}", "cc", rf"<b>cc[ -]{elements}(?![\w-])", MENTION))
    out += [Rule(label, keyword, _spaced(expression), priority) for label, keyword, expression, priority in NOTICES]
    return [r._replace(expression=r.expression.replace("<b>", BEGIN).replace("<e>", END)) for r in out]


def _rule_table() -> Column:
    """The rules as one constant array, strongest first."""
    rows = [
        f"named_struct('rule', {i}, 'label', {literal(r.label)}, 'keyword', {literal(r.keyword)}, "
        f"'expression', {literal(r.expression)}, 'priority', {r.priority})"
        for i, r in enumerate(rules())
    ]
    return F.expr(f"array({', '.join(rows)})")


def _keywords() -> list[str]:
    return sorted({r.keyword for r in rules()})


def detections(lowered: Column, present: Column) -> Column:
    """array<struct<rule, label, priority, start, end>> in code points, before suppression."""
    active = F.filter(_rule_table(), lambda r: F.array_contains(present, r["keyword"]))
    empty = F.expr(f"cast(array() as array<struct<{_DETECTION}>>)")

    def spans(r: Column) -> Column:
        # Text between the matches and the matches themselves, in turn, give the positions.
        between = F.split(lowered, r["expression"], -1)
        matches = F.regexp_extract_all(lowered, r["expression"], F.lit(0))
        lengths = F.zip_with(matches, between, lambda m, b: F.struct(F.length(b).alias("gap"), F.length(m).alias("own")))
        lengths = F.filter(lengths, lambda x: x["own"].isNotNull())

        def place(at: Column, x: Column) -> Column:
            begin = at + x["gap"]
            return F.struct(
                r["rule"].alias("rule"), r["label"].alias("label"), r["priority"].alias("priority"),
                begin.alias("start"), (begin + x["own"]).alias("end"),
            )

        ends = running(lengths, F.lit(0), lambda at, x: at + x["gap"] + x["own"], lambda at, total: at + total, place, empty)
        return F.when(F.regexp_like(lowered, r["expression"]), ends).otherwise(empty)

    return F.flatten(F.transform(active, spans))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(items: Column, zero: Column, add, merge, emit, empty: Column) -> Column:
    """``emit(state, item)`` of every item of an array, where ``add`` made the state of ``zero`` and all items before.

    An array that grows by an item is copied each time, so this goes by chunks: ``merge(state, state)`` gives the states that
    chunks start with. ``empty`` is the array of no results.
    """
    no_states = F.filter(F.array(zero), lambda _: F.lit(False))

    def inside(chunk: Column, before: Column) -> Column:
        start = F.struct(before.alias("state"), empty.alias("found"))
        step = lambda acc, x: F.struct(
            add(acc["state"], x).alias("state"), F.array_append(acc["found"], emit(acc["state"], x)).alias("found")
        )
        return F.aggregate(chunk, start, step)["found"]

    def starts(chunks: Column) -> Column:
        start = F.struct(zero.alias("state"), no_states.alias("found"))
        step = lambda acc, total: F.struct(
            merge(acc["state"], total).alias("state"), F.array_append(acc["found"], acc["state"]).alias("found")
        )
        return F.aggregate(F.transform(chunks, lambda c: F.aggregate(c, zero, add)), start, step)["found"]

    def whole(own: Column) -> Column:
        last = ((F.size(own) - 1) / ITEMS).cast("int")
        chunks = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(own, k * ITEMS + 1, F.lit(ITEMS)))

        def by_chunk(chunks: Column) -> Column:
            return _let(starts(chunks), lambda s: F.flatten(F.transform(chunks, lambda c, k: inside(c, F.get(s, k)))))

        return _let(chunks, by_chunk)

    return _let(items, lambda own: F.when(F.size(own) > 0, whole(own)).otherwise(empty))


def unsuppressed(found: Column) -> Column:
    """Detections that lie inside no stronger one: one of a higher priority, or of the same and longer, or an earlier rule.

    Sorted by start, longer ones first, then by strength, a detection is suppressed by those before it alone: if one of at
    least its priority ends no earlier. One pass holds the largest end for each least priority.
    """
    fields = ("rule", "label", "priority", "start", "end")
    row = lambda d: F.struct(
        d["start"].alias("start"), (-d["end"]).alias("to"), (-d["priority"]).alias("weak"), d["rule"].alias("rule"), d["label"].alias("label")
    )
    ordered = F.array_sort(F.transform(found, row))
    ordered = F.transform(
        ordered,
        lambda d: F.struct(
            d["rule"].alias("rule"), d["label"].alias("label"), (-d["weak"]).alias("priority"), d["start"].alias("start"), (-d["to"]).alias("end")
        ),
    )
    none = F.array(*[F.lit(-1)] * max(CONFIDENCE))
    add = lambda ends, d: F.transform(
        ends, lambda e, p: F.when(p < d["priority"], F.greatest(e, d["end"])).otherwise(e)
    )
    merge = lambda x, y: F.zip_with(x, y, lambda a, b: F.greatest(a, b))
    emit = lambda ends, d: F.struct(
        *[d[f].alias(f) for f in fields], (F.get(ends, d["priority"] - 1) < d["end"]).alias("stays")
    )
    empty = F.expr(f"cast(array() as array<struct<{_DETECTION}, stays: boolean>>)")
    marked = F.filter(running(ordered, none, add, merge, emit, empty), lambda d: d["stays"])
    return F.transform(marked, lambda d: F.struct(*[d[f].alias(f) for f in fields]))


def phrases(lowered: Column) -> Column:
    """array<struct<label, word>>: where the fixed phrases stand, words counted from 0."""
    words = F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))

    def at(words_: Column, i: Column, phrase: tuple[str, ...]) -> Column:
        same = F.get(words_, i) == phrase[0]
        for k, word in enumerate(phrase[1:], 1):
            same = same & F.coalesce(F.get(words_, i + k) == word, F.lit(False))
        return same

    def label(i: Column) -> Column:
        out = F.lit(None).cast("string")
        for name, phrase in PHRASES.items():
            out = F.when(at(F.col("_words"), i, phrase), F.lit(name)).otherwise(out)
        return out

    indices = F.sequence(F.lit(0), F.size("_words") - 1)
    found = F.transform(indices, lambda i: F.struct(label(i).alias("label"), i.cast("long").alias("word")))
    return words, F.filter(found, lambda x: x["label"].isNotNull())


#: Every rule's match holds one of these stems, so a text without any of them has no detection.
STEMS = (
    "licen", "spdx", "creativecommons", "creative commons", "cc-by", "cc by", "cc0", "gpl", "public domain", "reserved",
    "copyright", "proprietary", "confidential", "reproduc", "permission", "warrant", "redistribution", "mpl", "bsd",
    ".org/", ".net/", ".com/", ".co/", "unlicense", "ofl", "eupl", "no attribution", "wtfpl",
)


def _holds(folded: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(True)
    for w in words:
        out = out & F.contains(folded, F.lit(w))
    return out


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def _phrase_gate() -> str:
    """An expression that any folded text with a fixed phrase matches."""
    return "|".join(f"{_NOT_WORD}+".join(p) for p in PHRASES.values())


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, phrases array<struct<label, word>>, detections array<struct<rule, label, priority, start, end>>.

    Most texts stop at the first gate, plain substring tests. They run on ``lower``, which folds more than A-Z and
    therefore misses nothing.
    """
    rows = docs.select(F.col("doc_id").cast("long"), whole_text("text").alias("_text"))
    rows = rows.select("doc_id", "_text", F.lower("_text").alias("_folded"))
    folded = F.col("_folded")
    phrase = _any([_holds(folded, p) for p in PHRASES.values()]) & F.regexp_like(folded, F.lit(_phrase_gate()))
    # Names may be wrapped at any white space, so the words of a stem stand alone, and keywords meet single blanks. The
    # folded text is bound once, not once a keyword.
    stem = _any([_holds(folded, tuple(s.split())) for s in STEMS])
    keywords = F.array(*[F.lit(k) for k in _keywords()])
    single = F.array(F.regexp_replace(folded, F.lit(r"\s+"), F.lit(" ")))
    present = F.get(F.transform(single, lambda t: F.filter(keywords, lambda k: F.contains(t, k))), F.lit(0))
    rows = rows.select(
        "doc_id",
        "_text",
        F.size(F.regexp_extract_all("_text", F.lit(WORD_ANY_CASE), F.lit(0))).cast("long").alias("n_words"),
        phrase.alias("_phrase"),
        F.when(stem, present).alias("_present"),
    )
    lowered = F.when(F.col("_phrase") | (F.size("_present") > 0), lower_ascii(F.col("_text")))
    rows = rows.select("doc_id", "n_words", "_phrase", "_present", lowered.alias("_lowered"))
    words, found = phrases(F.col("_lowered"))
    rows = rows.select(
        "doc_id",
        "n_words",
        F.when(F.col("_phrase"), words).alias("_words"),
        F.when(F.size("_present") > 0, detections(F.col("_lowered"), F.col("_present"))).alias("_found"),
    )
    no_phrase = F.expr("cast(array() as array<struct<label: string, word: bigint>>)")
    no_detection = F.expr(
        f"cast(array() as array<struct<{_DETECTION}>>)"
    )
    return rows.select(
        "doc_id",
        "n_words",
        F.coalesce(F.when(F.size("_words") > 0, found), no_phrase).alias("phrases"),
        F.coalesce(F.when(F.size("_found") > 0, unsuppressed(F.col("_found"))), no_detection).alias("detections"),
    )


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    labels = lambda c: F.array_distinct(F.transform(c, lambda x: x["label"]))
    base = labels(F.col("phrases"))
    sure = F.transform(
        "detections",
        lambda d: F.create_map(*[F.lit(x) for p in CONFIDENCE.items() for x in p])[d["priority"]],
    )
    phrase = F.when(F.size("phrases") > 0, PHRASE_CONFIDENCE).otherwise(0.0)
    return found.select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min(F.transform("phrases", lambda x: x["word"])).alias("first_word"),
        F.array_max(F.transform("phrases", lambda x: x["word"])).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, labels(F.col("detections")))), ",").alias("labels"),
        F.greatest(phrase, F.coalesce(F.array_max(sure), F.lit(0.0))).alias("score"),
    )
