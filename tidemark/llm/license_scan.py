"""License scans: ordered signature rules behind a keyword prefilter."""

from __future__ import annotations

import itertools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, documents, id_and_text

#: Fixed values of the contract: base phrases and their labels; what lies between words.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # the same before A-Z are lower-cased


@dataclass(frozen=True)
class Signature:
    """A regular expression over space-joined lower-case words, tried only if ``keyword`` is a word.

    Where detections overlap, one that lies inside another of a smaller ``priority`` number, or of
    the same number and greater length, is suppressed.
    """

    label: str
    keyword: str
    pattern: str
    priority: int


#: Full titles with version: (label, keyword, title, versions).
FAMILIES = (
    ("gpl", "gpl", r"gnu gpl", "1 2 3"),
    ("gpl", "gnu", r"gnu general public licen[sc]e", "1 2 3"),
    ("lgpl", "lgpl", r"gnu lgpl", "2 2.1 3"),
    ("lgpl", "lesser", r"gnu lesser general public licen[sc]e", "2.1 3"),
    ("lgpl", "library", r"gnu library general public licen[sc]e", "2"),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[sc]e", "1 3"),
    ("gfdl", "documentation", r"gnu free documentation licen[sc]e", "1.1 1.2 1.3"),
    ("apache", "apache", r"apache(?: software)? licen[sc]e", "1.0 1.1 2.0"),
    ("mpl", "mozilla", r"mozilla public licen[sc]e", "1.0 1.1 2.0"),
    ("epl", "eclipse", r"eclipse public licen[sc]e", "1.0 2.0"),
    ("edl", "eclipse", r"eclipse distribution licen[sc]e", "1.0"),
    ("cpl", "common", r"common public licen[sc]e", "1.0"),
    ("cddl", "common", r"common development and distribution licen[sc]e", "1.0 1.1"),
    ("cpal", "common", r"common public attribution licen[sc]e", "1.0"),
    ("ipl", "ibm", r"ibm public licen[sc]e", "1.0"),
    ("eupl", "european", r"european union public licen[sc]e", "1.0 1.1 1.2"),
    ("osl", "open", r"open software licen[sc]e", "1.0 2.0 2.1 3.0"),
    ("afl", "academic", r"academic free licen[sc]e", "1.1 1.2 2.0 2.1 3.0"),
    ("artistic", "artistic", r"artistic licen[sc]e", "1.0 2.0"),
    ("boost", "boost", r"boost software licen[sc]e", "1.0"),
    ("ofl", "sil", r"sil open font licen[sc]e", "1.0 1.1"),
    ("lppl", "latex", r"latex project public licen[sc]e", "1.0 1.1 1.2 1.3"),
    ("zpl", "zope", r"zope public licen[sc]e", "1.1 2.0 2.1"),
    ("php", "php", r"php licen[sc]e", "3.0 3.01"),
    ("npl", "netscape", r"netscape public licen[sc]e", "1.0 1.1"),
    ("apsl", "apple", r"apple public source licen[sc]e", "1.0 1.1 1.2 2.0"),
    ("qpl", "q", r"q public licen[sc]e", "1.0"),
    ("sspl", "side", r"server side public licen[sc]e", "1"),
    ("busl", "business", r"business source licen[sc]e", "1.0 1.1"),
    ("elastic", "elastic", r"elastic licen[sc]e", "1.0 2.0"),
    ("odbl", "database", r"open data commons open database licen[sc]e", "1.0"),
    ("odc-by", "attribution", r"open data commons attribution licen[sc]e", "1.0"),
    ("pddl", "public", r"public domain dedication and licen[sc]e", "1.0"),
    ("cecill", "cecill", r"cecill(?: free software)? licen[sc]e(?: agreement)?", "1.0 2.0 2.1"),
    ("ms-pl", "microsoft", r"microsoft public licen[sc]e", "1"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[sc]e", "1"),
    ("rpl", "reciprocal", r"reciprocal public licen[sc]e", "1.1 1.5"),
    ("upl", "universal", r"universal permissive licen[sc]e", "1.0"),
    ("ncsa", "illinois", r"university of illinois ncsa open source licen[sc]e", "1"),
    ("wtfpl", "fuck", r"do what the fuck you want to public licen[sc]e", "1 2"),
)

#: Short identifiers as they follow "spdx license identifier" or "licensed under".
IDENTIFIERS = {
    "mit": "mit", "mit 0": "mit-0", "isc": "isc", "zlib": "zlib", "0bsd": "0bsd", "unlicense": "unlicense",
    "bsd 2 clause": "bsd-2", "bsd 3 clause": "bsd-3", "bsd 4 clause": "bsd-4", "apache 1 1": "apache",
    "apache 2 0": "apache", "gpl 1 0": "gpl", "gpl 2 0": "gpl", "gpl 3 0": "gpl", "lgpl 2 0": "lgpl",
    "lgpl 2 1": "lgpl", "lgpl 3 0": "lgpl", "agpl 1 0": "agpl", "agpl 3 0": "agpl", "mpl 1 1": "mpl",
    "mpl 2 0": "mpl", "epl 1 0": "epl", "epl 2 0": "epl", "cddl 1 0": "cddl", "cddl 1 1": "cddl",
    "bsl 1 0": "boost", "busl 1 1": "busl", "cc0 1 0": "cc0", "cc by 3 0": "cc-by", "cc by 4 0": "cc-by",
    "cc by sa 3 0": "cc-by-sa", "cc by sa 4 0": "cc-by-sa", "cc by nc 4 0": "cc-by-nc",
    "cc by nd 4 0": "cc-by-nd", "cc by nc sa 4 0": "cc-by-nc-sa", "cc by nc nd 4 0": "cc-by-nc-nd",
    "ofl 1 1": "ofl", "artistic 2 0": "artistic", "psf 2 0": "psf", "python 2 0": "psf", "php 3 01": "php",
    "ncsa": "ncsa", "postgresql": "postgresql", "openssl": "openssl", "ruby": "ruby", "x11": "x11",
    "wtfpl": "wtfpl", "vim": "vim", "eupl 1 2": "eupl", "ms pl": "ms-pl", "upl 1 0": "upl", "zpl 2 1": "zpl",
}

#: Phrases that name or quote a license without a version: (label, keyword, pattern).
PHRASES = (
    ("mit", "mit", r"(?:the )?mit licen[sc]e"),
    ("mit", "mit", r"licen[sc]ed under (?:the )?(?:terms of the )?mit"),
    ("mit", "sublicense", r"to use copy modify merge publish distribute sublicense and or sell"),
    ("apache", "apache", r"(?:the )?apache(?: software)? licen[sc]e"),
    ("apache", "apache", r"you may not use this file except in compliance with the licen[sc]e"),
    ("gpl", "public", r"(?:gnu )?general public licen[sc]e"),
    ("gpl", "gnu", r"gnu gpl"),
    ("lgpl", "lesser", r"lesser general public licen[sc]e"),
    ("lgpl", "library", r"library general public licen[sc]e"),
    ("agpl", "affero", r"affero general public licen[sc]e"),
    ("bsd", "bsd", r"bsd(?: style)? licen[sc]e"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms"),
    ("bsd-2", "bsd", r"(?:bsd 2 clause|2 clause bsd|simplified bsd) licen[sc]e"),
    ("bsd-3", "bsd", r"(?:bsd 3 clause|3 clause bsd|modified bsd|revised bsd|new bsd) licen[sc]e"),
    ("bsd-4", "bsd", r"(?:bsd 4 clause|4 clause bsd|original bsd) licen[sc]e"),
    ("bsd-3", "endorse", r"neither the name of .{1,80}? nor the names of its contributors may be used to endorse"),
    ("isc", "isc", r"isc licen[sc]e"),
    ("isc", "permission", r"permission to use copy modify and or distribute this software for any purpose"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[sc]e"),
    ("zlib", "altered", r"altered source versions must be plainly marked as such"),
    ("mpl", "mozilla", r"mozilla public licen[sc]e"),
    ("epl", "eclipse", r"eclipse public licen[sc]e"),
    ("boost", "boost", r"boost software licen[sc]e"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("public-domain", "domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("cc0", "cc0", r"cc0"),
    ("cc0", "zero", r"creative commons zero"),
    ("psf", "python", r"python software foundation licen[sc]e"),
    ("postgresql", "postgresql", r"postgresql licen[sc]e"),
    ("openssl", "openssl", r"openssl licen[sc]e"),
    ("ruby", "ruby", r"ruby licen[sc]e"),
    ("x11", "x11", r"x11 licen[sc]e"),
    ("vim", "vim", r"vim licen[sc]e"),
    ("beerware", "beer", r"beer ?ware licen[sc]e"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("proprietary", "rights", r"all rights reserved"),
    ("proprietary", "confidential", r"proprietary and confidential"),
)

#: Parts of the names of creative commons licenses, in the order in which they are written.
COMMONS = {"by": "attribution", "nc": "non ?commercial", "nd": "no ?deriv(?:ative|ative work|)s", "sa": "share ?alike"}


def _family_rules() -> list[Signature]:
    rules = []
    for (label, keyword, title, versions), form in itertools.product(FAMILIES, ("{}", "(?:v|version) ?{}")):
        for version in versions.split():
            number = version.replace(".0", "(?: 0)?").replace(".", " ?")
            rules.append(Signature(label, keyword, f"{title} {form.format(number)}", 1))
    return rules


def _commons_rules() -> list[Signature]:
    rules = []
    for extra in ((), ("nc",), ("nd",), ("sa",), ("nc", "nd"), ("nc", "sa")):
        parts = ("by", *extra)
        name = " ".join(COMMONS[part] for part in parts)
        for version in ("", " [1234](?: ?[05])?"):
            rules.append(Signature("cc-" + "-".join(parts), "commons", f"creative commons {name}{version}", 1 if version else 2))
    return rules


def signatures() -> tuple[Signature, ...]:
    """All rules, those of the smallest priority number first."""
    rules = [Signature(label, "identifier", f"spdx licen[sc]e identifier {text}(?: only| or later)?", 0) for text, label in IDENTIFIERS.items()]
    rules += [Signature(label, "licensed", f"licensed under (?:the )?(?:terms of the )?{text}", 1) for text, label in IDENTIFIERS.items()]
    rules += _family_rules() + _commons_rules()
    rules += [Signature(label, keyword, pattern, 2) for label, keyword, pattern in PHRASES]
    return tuple(sorted(rules, key=lambda rule: rule.priority))


#: How much a kept detection of each priority says about the text being licensed.
WEIGHT = (1.0, 0.9, 0.6)


def _whole(pattern: Column) -> Column:
    """The pattern between spaces, so that it matches whole words only."""
    return F.concat(F.lit("(?<= )("), pattern, F.lit(")(?= )"))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _base(joined: Column, phrase: str, label: str) -> Column:
    """How often a base phrase stands in the text, and the words at which it first and last starts."""
    parts = F.split(joined, f"(?<= ){phrase}(?= )", -1)
    length = phrase.count(" ")
    found = F.struct(
        (F.size(parts) - 1).cast("long").alias("n"),
        (_spaces(F.get(parts, F.lit(0))) - 1).cast("long").alias("first"),
        (_spaces(joined) - _spaces(F.element_at(parts, -1)) - length - 1).cast("long").alias("last"),
        F.lit(label).alias("label"),
    )
    return F.when(F.contains(joined, F.lit(f" {phrase} ")), found)


def _found(joined: Column, rule: Column) -> Column:
    """Word intervals [first, last] of a rule's matches, from a copy of the text that marks them."""
    pattern = _whole(rule["pattern"])
    marked = F.split(F.regexp_replace(joined, pattern, F.lit("\u0001$1")), " ")
    starts = F.array_compact(F.transform(marked, lambda w, i: F.when(F.startswith(w, F.lit("\u0001")), i - 1)))
    spans = F.zip_with(
        starts,
        F.regexp_extract_all(joined, pattern, F.lit(1)),
        lambda first, hit: F.struct(
            first.alias("first"),
            (-first - _spaces(hit)).alias("minus_last"),
            rule["priority"].alias("priority"),
            rule["label"].alias("label"),
        ),
    )
    return F.when(F.regexp_like(joined, pattern), spans)


def _unsuppressed(found: Column) -> Column:
    """Detections that lie in no other of smaller priority number, nor in a longer one of the same.

    In the order of (first, -last, priority) whatever contains a detection stands before it, so a
    single pass with the furthest end per priority, and where that one starts, decides.
    """
    ends = F.array(*[F.struct(F.lit(-1).alias("last"), F.lit(-1).alias("first")) for _ in WEIGHT])
    none = F.array().cast("array<struct<first:int,last:int,label:string,priority:int>>")

    def step(acc: Column, x: Column) -> Column:
        last = -x["minus_last"]
        inside = F.lit(False)
        for p in range(len(WEIGHT)):
            end = F.get(acc["ends"], F.lit(p))
            longer = (end["last"] > last) | ((end["last"] == last) & (end["first"] < x["first"]))
            inside = inside | ((x["priority"] > p) & (end["last"] >= last)) | ((x["priority"] == p) & longer)
        ends = F.transform(
            acc["ends"],
            lambda end, p: F.when(
                (p == x["priority"]) & (last > end["last"]),
                F.struct(last.alias("last"), x["first"].alias("first")),
            ).otherwise(end),
        )
        own = F.struct(x["first"].alias("first"), last.alias("last"), x["label"].alias("label"), x["priority"].alias("priority"))
        return F.struct(
            ends.alias("ends"),
            F.when(inside, acc["kept"]).otherwise(F.concat(acc["kept"], F.array(own))).alias("kept"),
        )

    start = F.struct(ends.alias("ends"), none.alias("kept"))
    return F.aggregate(F.sort_array(found), start, step, lambda acc: acc["kept"])


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: word counts, base phrases, labels, a score, and the detections kept.

    detections: array of (first word, last word, label, priority). Texts that hold no keyword of a
    rule are never matched against it. A null or empty text has no words, null positions, empty
    labels and score 0. Rows are judged one by one, repeated ones too; nothing is shuffled.
    """
    rules = signatures()
    keywords = F.array(*[F.lit(k) for k in sorted({rule.keyword for rule in rules} | {"license"})])
    table = F.array(
        *[
            F.struct(
                F.lit(rule.label).alias("label"), F.lit(rule.keyword).alias("keyword"),
                F.lit(rule.pattern).alias("pattern"), F.lit(rule.priority).alias("priority"),
            )
            for rule in rules
        ]
    )
    text, joined = F.col("text"), F.col("joined")
    rows = id_and_text(docs, id_col, text_col).select(
        "doc_id", F.regexp_replace(F.concat(F.lit(" "), text, F.lit(" ")), GAP_ANY_CASE, " ").alias("spaced")
    )
    rows = rows.select(
        "doc_id",
        "spaced",
        (_spaces(F.col("spaced")) - 1).cast("long").alias("n_words"),
        F.array_intersect(F.split(F.lower("spaced"), " "), keywords).alias("keywords"),
    )
    rows = rows.select(
        "doc_id", "n_words", "keywords", F.when(F.size("keywords") > 0, ascii_lower(F.col("spaced"))).alias("joined")
    )
    tried = F.filter(table, lambda rule: F.array_contains("keywords", rule["keyword"]))
    found = F.flatten(F.array_compact(F.transform(tried, lambda rule: _found(joined, rule))))
    rows = rows.select(
        "doc_id",
        "n_words",
        F.array_compact(F.array(*[_base(joined, phrase, label) for phrase, label in BASE.items()])).alias("base"),
        F.when(joined.isNotNull(), _unsuppressed(found)).alias("kept"),
    )
    base, kept = F.col("base"), F.col("kept")
    base_labels = F.array_sort(F.array_distinct(base["label"]))
    weights = F.array(*[F.lit(w) for w in WEIGHT])
    score = F.array_max(F.transform(kept, lambda x: F.get(weights, x["priority"])))
    return rows.select(
        "doc_id",
        "n_words",
        F.aggregate(base["n"], F.lit(0).cast("long"), lambda a, n: a + n).alias("n_base"),
        F.array_min(base["first"]).alias("first_word"),
        F.array_max(base["last"]).alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(
            F.array_sort(F.array_union(base_labels, F.coalesce(kept["label"], F.array().cast("array<string>")))), ","
        ).alias("labels"),
        F.greatest(F.coalesce(score, F.lit(0.0)), F.when(F.size(base) > 0, WEIGHT[-1]).otherwise(0.0)).alias("score"),
        F.coalesce(kept, F.array().cast("array<struct<first:int,last:int,label:string,priority:int>>")).alias("detections"),
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))
