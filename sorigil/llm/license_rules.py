"""Licence scan by sentence rules, with DataFrame functions only.

A text is cut into sentences at line ends and behind ``.``, ``!``, ``?`` and ``;`` before white space. Lines that are no known
sentence are joined with their neighbours (up to the end of the sentence, a blank line or the start of another known
sentence; comment marks fall away), since notices are often wrapped. Sentences that hold a licence word are normalised (lower case, everything but letters, digits and dots a single space, dots at the end
gone) and mapped to the identifier of the first known licence sentence they match; a sentence's version becomes
part of its identifier. The identifiers of a document, in order of the text, are then matched against the ordered
rules: the first rule that fits takes its identifiers out of the sequence, as often as it fits, then the next one
is tried. What no rule takes is reported as left over.

All work is per row, without a shuffle; texts without any licence word cost one pattern search.

``n_sentences`` counts sentences as cut at line ends. The SQL twin does not join lines and knows ``LICENCE_WORDS`` only, so it holds
for notices on one line that have one of these. A version stands at most 200 characters behind its licence's name. Texts cost time in proportion to their length,
also where one line repeats a licence word all over. Results: one row per row of the table. Null, empty and licence-free texts have empty lists. Repeated rows
each get their row. Only the id and the text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words of licence sentences; with KNOWN_WORDS, every known sentence has one of them, also when it is wrapped.
LICENCE_WORDS = "(?i)licen[cs]e|permission|redistribut|warrant|public domain|liab|spdx|copyright notice|provided .?as is"
_GAP = "[^a-z0-9]+"
_ALONE = "(?<![a-z0-9])"
KNOWN_WORDS = LICENCE_WORDS + f"|{_ALONE}[al]?gpl|{_ALONE}cc0(?![a-z0-9])|{_ALONE}cc{_GAP}by|creative{_GAP}commons|public{_GAP}domain|software{_GAP}is{_GAP}provided|endorse"
# Where joined lines end: behind a sentence, at a blank line (comment marks aside), before the start of a known sentence.
_MARKS = "[\\x20\\x09\\x0D*#/%;-]*"
_STARTS = "permission (?:is hereby|to use)|redistribution and use|neither the name of|in no event shall|the above copyright notice and|th(?:e|is) software is provided"
JOINED_END = f"(?<=[.!?])\\n|\\n{_MARKS}\\n|\\n(?={_MARKS}(?i:{_STARTS}))"

# Identifier and pattern (on normalised sentences) of known licence sentences, most special first.
# A group in a pattern is the version and is added to the identifier.
SENTENCES = [
    ("SPDX", "spdx license identifier ([a-z0-9][a-z0-9. ]*)$"),
    ("AGPLfree", "free software.*gnu affero general public license.*version ([0-9.]+)"),
    ("LGPLfree", "free software.*gnu (?:lesser|library) general public license.*version ([0-9.]+)"),
    ("GPLfree", "free software.*gnu general public license.*version ([0-9.]+)"),
    ("AGPLref", "(?:licensed|released|distributed|available).*(?:gnu affero general public license|agpl)[a-z ]{0,200}v?([0-9.]+)"),
    ("LGPLref", "(?:licensed|released|distributed|available).*(?:gnu (?:lesser|library) general public license|lgpl)[a-z ]{0,200}v?([0-9.]+)"),
    ("GPLref", "(?:licensed|released|distributed|available).*(?:gnu general public license|gpl)[a-z ]{0,200}v?([0-9.]+)"),
    ("ApacheUse", "you may not use (?:this|the) (?:file|work|software) except in compliance with the license"),
    ("ApacheBasis", "distributed under the license is distributed on an as is basis"),
    ("ApacheRef", "(?:licensed|released|distributed|available).*apache license[a-z ]{0,200}v?([0-9.]+)"),
    ("MozillaRef", "(?:subject to|licensed under|under) the terms of the mozilla public license[a-z ]{0,200}v?[. ]*([0-9.]+)"),
    ("CCRef", "(?:licensed|released|available).*(?:cc|creative commons) (by(?: nc| nd| sa)* [0-9.]+)"),
    ("CCZero", "(?:cc0|creative commons zero|dedicated to the public domain)"),
    ("MITRef", "(?:licensed|released|distributed|available).* mit license"),
    ("BSDRef", "(?:licensed|released|distributed|available).*\\bbsd license"),
    ("MITGrant", "^permission is hereby granted free of charge to any person obtaining a copy"),
    ("MITNotice", "^the above copyright notice and this permission notice shall be included"),
    ("AsIs", "^(?:the|this) software is provided (?:by .* )?as is"),
    ("Liability", "^in no event shall .* be liable"),
    ("BSDGrant", "^redistribution and use in source and binary forms"),
    ("BSDSource", "redistributions of source code must retain"),
    ("BSDBinary", "redistributions in binary form must reproduce"),
    ("BSDNames", "^neither the name of .* may be used to endorse"),
    ("ISCGrant", "^permission to use copy modify and or distribute this software for any purpose"),
    ("NoWarranty", "without (?:any )?warrant|without even the implied warranty"),
]

# The ordered rules, licence and sequence of bracketed identifiers (a version stands for itself as \\1).
RULES = [
    ("SPDX-\\1", "<SPDX:([^>]+)>"),
    ("BSD-3-Clause", "<BSDGrant><BSDSource><BSDBinary><BSDNames>(?:<AsIs>)?(?:<Liability>)?"),
    ("BSD-2-Clause", "<BSDGrant><BSDSource><BSDBinary>(?:<AsIs>)?(?:<Liability>)?"),
    ("MIT", "<MITGrant><MITNotice>(?:<AsIs>)?(?:<Liability>)?"),
    ("ISC", "<ISCGrant>(?:<AsIs>)?(?:<Liability>)?"),
    ("AGPL-\\1-or-later", "<AGPLfree:([^>]+)>(?:<NoWarranty>)?"),
    ("LGPL-\\1-or-later", "<LGPLfree:([^>]+)>(?:<NoWarranty>)?"),
    ("GPL-\\1-or-later", "<GPLfree:([^>]+)>(?:<NoWarranty>)?"),
    ("Apache-\\1", "<ApacheRef:([^>]+)>(?:<ApacheUse>)?(?:<ApacheBasis>)?(?:<NoWarranty>)?"),
    ("Apache-2.0", "<ApacheUse><ApacheBasis>"),
    ("MPL-\\1", "<MozillaRef:([^>]+)>"),
    ("AGPL-\\1", "<AGPLref:([^>]+)>"),
    ("LGPL-\\1", "<LGPLref:([^>]+)>"),
    ("GPL-\\1", "<GPLref:([^>]+)>"),
    ("CC-\\1", "<CCRef:([^>]+)>"),
    ("CC0-1.0", "<CCZero>"),
    ("MIT", "<MITRef>(?:<MITGrant>)?(?:<MITNotice>)?"),
    ("BSD", "<BSDRef>"),
]


def normal(s: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(s), "[^a-z0-9.]+", " "), F.lit(" ."))


def cut_text(text: Column) -> Column:
    """The text with a line end behind every sentence; the marks of ``identifiers`` are not in it."""
    return F.regexp_replace(F.translate(text, "\x01\x02", "  "), "([.!?;])[\\x20\\x09\\x0D]+", "$1\n")


def sentences(cut: Column) -> Column:
    return F.filter(F.split(cut, "\n"), lambda s: s.rlike(KNOWN_WORDS))


def identifiers(cut: Column) -> Column:
    """The known sentences of a cut text in order: those of single lines, and those of what lies between these, joined."""
    units = F.filter(F.split(cut, JOINED_END), lambda u: u.rlike(KNOWN_WORDS))

    def marked(line: Column) -> Column:
        found = F.when(line.rlike(KNOWN_WORDS), identifier(normal(line)))  # as in SQL
        return F.coalesce(F.concat(F.lit("\x01\x02"), found, F.lit("\x01")), line)

    def joined(lines: Column) -> Column:
        """The identifier of joined lines; a digest with cc0 in it on one of them is no licence."""
        zero = lines.rlike("\\bcc0\\b|creative commons zero|dedicated to the public domain")
        found = identifier(lines)
        return F.when((found != "CCZero") | zero, found)

    parts = F.flatten(F.transform(units, lambda u: F.split(F.array_join(F.transform(F.split(u, "\n"), marked), "\n"), "\x01")))
    named = F.transform(parts, lambda p: F.when(p.startswith("\x02"), F.replace(p, F.lit("\x02"))).otherwise(F.when(p.rlike(KNOWN_WORDS), joined(normal(p)))))
    return F.filter(named, lambda i: i.isNotNull())


def found_in(sentence: Column, pattern: str) -> tuple[Column, Column]:
    """Whether a pattern of parts with anything between them is in the sentence, and its group.

    Parts are searched one behind the other, each behind the first place of those before it; the last one takes its last place, as a greedy
    pattern does. Every step is one pass, however often a part repeats; the pattern as a whole would try all places of a part
    against all of the next."""
    *heads, last = [pattern] if pattern.startswith("^") else pattern.split(".*")
    rest = sentence
    for head in heads:
        rest = F.regexp_extract(rest, f"^.*?{head}(.*)$", 1)
    return rest.rlike(last), F.regexp_extract(rest, f"^.*{last}" if heads else last, 1)


def identifier(sentence: Column) -> Column:
    """The identifier of a normalised sentence, null if it is no known one."""
    out = F.lit(None).cast("string")
    for name, pattern in reversed(SENTENCES):
        fits, group = found_in(sentence, pattern)
        version = F.replace(F.regexp_replace(group, "[. ]+$", ""), F.lit(" "), F.lit("-")) if "([" in pattern or "(by" in pattern else None
        out = F.when(fits, F.lit(name) if version is None else F.concat(F.lit(name + ":"), version)).otherwise(out)
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_sentences, identifiers, licences and left_over (comma-joined, in order of the text or of the rules)."""
    one = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    none = F.array().cast("array<string>")
    cut = one.select(id_col, F.when(F.col("t").rlike(KNOWN_WORDS), cut_text(F.col("t"))).alias("cut"))
    known = cut.select(
        id_col,
        F.when(F.col("cut").isNull(), F.lit(0)).otherwise(F.size(sentences(F.col("cut")))).cast("long").alias("n_sentences"),
        F.when(F.col("cut").isNull(), none).otherwise(identifiers(F.col("cut"))).alias("ids"),
    )
    out = known.withColumns({"left": F.array_join(F.transform("ids", lambda i: F.concat(F.lit("<"), i, F.lit(">"))), ""), "found": none})
    for licence, pattern in RULES:
        before, version, after = licence.partition("\\1")
        taken = F.regexp_extract_all("left", F.lit(pattern if version else f"({pattern})"), F.lit(1))
        names = F.transform(taken, lambda v: F.concat(F.lit(before), v, F.lit(after)) if version else F.lit(licence))
        out = out.withColumns({"found": F.when(F.col("left") != "", F.concat("found", names)).otherwise(F.col("found")), "left": F.regexp_replace("left", pattern, "")})
    return out.select(
        id_col, "n_sentences", F.array_join("ids", ",").alias("identifiers"), F.array_join("found", ",").alias("licences"),
        F.replace(F.substring(F.col("left"), F.lit(2), F.length("left") - 2), F.lit("><"), F.lit(",")).alias("left_over"),
    )
