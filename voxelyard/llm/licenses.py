"""License scan by ordered signature rules, by SQL functions alone.

A rule is a regex with a keyword, a label, a priority and a confidence: each of the names of ``NAMES`` in each
of the forms of ``FORMS`` in which a license is named, and each of the sentences of license texts of
``SENTENCES``, all written by hand.  A blank in a rule stands for any run of white space and comment marks, so
wrapped and commented headers match in place.  Only rules whose keyword a text holds are tried; their patterns are constants
of the plan, compiled once a task.  A keyword is three letters or more that every match holds in one piece, however it is wrapped, so the keywords
themselves are the gate.  The forms of a name are tried in one pass, as alternatives, and what a match begins with tells which
it is.

Detections may overlap, as "apache license, version 2.0" and "apache license" do.  A detection that lies
within one of a higher priority, or of the same priority that starts no later and ends no sooner, is
suppressed; of those with the same span and priority the rule that comes first stays, and names with a version
come before those without.  Running maxima over the detections in order of their start find these without
comparing pairs.

Base phrases are found word by word, wherever their words stand consecutively, and keep their labels.

Defined cases: null and empty texts have no words and no labels, null places and score 0; a text, and what
stands in a rule's open place, may be of any length; repeated rows, and rows with equal or null ids, are
scanned each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import ascii_lower, column, table

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # before lower-casing
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrase: label.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Confidence of a base phrase alone.
BASE_SCORE = 0.6

#: What a blank in a rule stands for, and what ~ does: a blank or a hyphen.
GAP = r"[\x20\x09-\x0D*#/;%>|]++"
#: Fixed values. Label, pattern of the license's name, keyword that every match holds, and whether the name
#: has a version, so that it needs no "license" after it. The first of two equal matches counts.
VERSION = r"(?:,? v(?:ersion|er)?\.? ?|,? |-|/)?v?"
CREATIVE = [  # label, short and long name
    ("cc-by-nc-nd", "cc~by~nc~nd", r"creative commons attribution~non ?commercial~no ?deriv(?:ative)?s"), ("cc-by-nc-sa", "cc~by~nc~sa", "creative commons attribution~non ?commercial~share ?alike"),
    ("cc-by-nc", "cc~by~nc", "creative commons attribution~non ?commercial"), ("cc-by-nd", "cc~by~nd", r"creative commons attribution~no ?deriv(?:ative)?s"),
    ("cc-by-sa", "cc~by~sa", "creative commons attribution~share ?alike"), ("cc-by", "cc~by", "creative commons attribution"),
]
NAMES = [
    *[(label, name + VERSION + r"[1-4]\.0(?: international)?", keyword, True) for label, *names in CREATIVE for name, keyword in zip(names, ("cc-by", "creative"))],
    *[(label, name, keyword, False) for label, *names in CREATIVE for name, keyword in zip(names, ("cc-by", "creative"))],
    ("apache-2.0", r"apache(?: software)?(?: licen[sc]e)?" + VERSION + r"2(?:\.0)?", "apache", True),
    ("apache-1.1", r"apache(?: software)?(?: licen[sc]e)?" + VERSION + r"1\.1", "apache", True),
    ("apache-1.0", r"apache(?: software)?(?: licen[sc]e)?" + VERSION + r"1\.0", "apache", True),
    ("agpl-3.0", r"(?:gnu )?affero general public licen[sc]e" + VERSION + r"3(?:\.0)?", "affero", True),
    ("agpl-3.0", r"(?:gnu )?agpl" + VERSION + r"3(?:\.0)?", "agpl", True),
    ("lgpl-2.0", r"(?:gnu )?(?:lesser|library) general public licen[sc]e" + VERSION + r"2(?:\.0)?", "general", True),
    ("lgpl-2.1", r"(?:gnu )?(?:lesser|library) general public licen[sc]e" + VERSION + r"2\.1", "general", True),
    ("lgpl-3.0", r"(?:gnu )?(?:lesser|library) general public licen[sc]e" + VERSION + r"3(?:\.0)?", "general", True),
    ("lgpl-2.0", r"(?:gnu )?lgpl" + VERSION + r"2(?:\.0)?", "lgpl", True),
    ("lgpl-2.1", r"(?:gnu )?lgpl" + VERSION + r"2\.1", "lgpl", True),
    ("lgpl-3.0", r"(?:gnu )?lgpl" + VERSION + r"3(?:\.0)?", "lgpl", True),
    ("gpl-1.0", r"(?:gnu )?general public licen[sc]e" + VERSION + r"1(?:\.0)?", "general", True),
    ("gpl-2.0", r"(?:gnu )?general public licen[sc]e" + VERSION + r"2(?:\.0)?", "general", True),
    ("gpl-3.0", r"(?:gnu )?general public licen[sc]e" + VERSION + r"3(?:\.0)?", "general", True),
    ("gpl-1.0", r"(?:gnu )?gpl" + VERSION + r"1(?:\.0)?", "gpl", True),
    ("gpl-2.0", r"(?:gnu )?gpl" + VERSION + r"2(?:\.0)?", "gpl", True),
    ("gpl-3.0", r"(?:gnu )?gpl" + VERSION + r"3(?:\.0)?", "gpl", True),
    ("gfdl-1.3", r"(?:gnu )?free documentation licen[sc]e" + VERSION + r"1\.3", "documentation", True),
    ("mpl-1.1", r"mozilla public licen[sc]e" + VERSION + r"1\.1", "mozilla", True),
    ("mpl-2.0", r"mozilla public licen[sc]e" + VERSION + r"2(?:\.0)?", "mozilla", True),
    ("mpl-1.1", r"mpl" + VERSION + r"1\.1", "mpl", True),
    ("mpl-2.0", r"mpl" + VERSION + r"2(?:\.0)?", "mpl", True),
    ("epl-1.0", r"eclipse public licen[sc]e" + VERSION + r"1(?:\.0)?", "eclipse", True),
    ("epl-1.0", r"epl" + VERSION + r"1(?:\.0)?", "epl", True),
    ("epl-2.0", r"eclipse public licen[sc]e" + VERSION + r"2(?:\.0)?", "eclipse", True),
    ("epl-2.0", r"epl" + VERSION + r"2(?:\.0)?", "epl", True),
    ("artistic-2.0", r"artistic licen[sc]e" + VERSION + r"2(?:\.0)?", "artistic", True),
    ("eupl-1.2", r"european union public licen[sc]e" + VERSION + r"1\.2", "european", True),
    ("eupl-1.2", r"eupl" + VERSION + r"1\.2", "eupl", True),
    ("boost-1.0", r"boost software licen[sc]e" + VERSION + r"1\.0", "boost", True),
    ("boost-1.0", r"bsl" + VERSION + r"1\.0", "bsl", True),
    ("bsd-2-clause", r"(?:simplified bsd|bsd~2~clause|(?:2|two)~clause bsd)", "bsd", True),
    ("bsd-3-clause", r"(?:new bsd|modified bsd|revised bsd|bsd~3~clause|(?:3|three)~clause bsd)", "bsd", True),
    ("bsd-4-clause", r"(?:original bsd|bsd~4~clause|(?:4|four)~clause bsd)", "bsd", True),
    ("0bsd", r"(?:0bsd|zero~clause bsd|bsd zero~clause)", "bsd", True),
    ("cc0", r"cc0(?:" + VERSION + r"1\.0)?(?: universal)?", "cc0", True),
    ("cc0", r"creative commons zero(?:" + VERSION + r"1\.0)?(?: universal)?", "creative", True),
    ("mit", r"mit", "mit", False),
    ("x11", r"x11", "x11", False),
    ("isc", r"isc", "isc", False),
    ("apache", r"apache(?: software)?", "apache", False),
    ("bsd", r"bsd", "bsd", False),
    ("agpl", r"(?:gnu )?affero general public", "affero", False),
    ("agpl", r"(?:gnu )?agpl", "agpl", False),
    ("lgpl", r"(?:gnu )?(?:lesser|library) general public", "general", False),
    ("lgpl", r"(?:gnu )?lgpl", "lgpl", False),
    ("gpl", r"(?:gnu )?general public", "general", False),
    ("gpl", r"(?:gnu )?gpl", "gpl", False),
    ("gfdl", r"(?:gnu )?free documentation", "documentation", False),
    ("mpl", r"mozilla public", "mozilla", False),
    ("mpl", r"mpl", "mpl", False),
    ("epl", r"eclipse public", "eclipse", False),
    ("cddl", r"common development and distribution", "development", False),
    ("cddl", r"cddl", "cddl", False),
    ("cpl", r"common public", "common", False),
    ("ipl", r"ibm public", "ibm", False),
    ("eupl", r"european union public", "european", False),
    ("osl", r"open software", "open", False),
    ("afl", r"academic free", "academic", False),
    ("artistic", r"(?:perl )?artistic", "artistic", False),
    ("zlib", r"zlib(?:/libpng)?", "zlib", False),
    ("boost", r"boost software", "boost", False),
    ("unlicense", r"(?:the )?unlicense", "unlicense", True),
    ("wtfpl", r"do what the fuck you want to public licen[sc]e", "fuck", True),
    ("wtfpl", r"wtfpl", "wtfpl", True),
    ("python", r"python software foundation", "python", False),
    ("python", r"psf", "psf", False),
    ("ruby", r"ruby", "ruby", False),
    ("php", r"php", "php", False),
    ("postgresql", r"postgresql", "postgresql", False),
    ("openssl", r"openssl", "openssl", False),
    ("sleepycat", r"sleepycat", "sleepycat", False),
    ("ncsa", r"(?:university of illinois/)?ncsa(?: open source)?", "ncsa", False),
    ("ms-pl", r"microsoft public", "microsoft", False),
    ("ms-rl", r"microsoft reciprocal", "microsoft", False),
    ("cecill", r"cecill(?:-[abc])?", "cecill", False),
    ("ofl", r"(?:sil )?open font", "font", False),
    ("odbl", r"open database", "database", False),
    ("upl", r"universal permissive", "permissive", False),
    ("elastic", r"elastic", "elastic", False),
    ("sspl", r"server side public", "server", False),
    ("busl", r"business source", "business", False),
    ("vim", r"vim", "vim", False),
    ("tcl", r"tcl(?:/tk)?", "tcl", False),
    ("ijg", r"independent jpeg group", "jpeg", False),
]
#: Form of naming: what stands before the name, priority, confidence. The last one is the name alone.
FORMS = [
    (r"spdx-license-identifier:(?: )?\(?", 5, 1.0),
    (r"licen[sc]ed under (?:the )?(?:terms of )?(?:the )?", 4, 0.95),
    (r"(?:re)?(?:released|distributed|available|provided|published|offered) under (?:the )?(?:terms of )?(?:the )?", 4, 0.9),
    (r"(?:subject to|governed by|covered by) (?:the )?(?:terms of )?(?:the )?", 3, 0.85),
    (r"licen[sc]e:(?: )?(?:the )?", 2, 0.75),
    (r"", 2, 0.8),
]
#: What may follow a name: "license", a version, "or later".
AFTER = r"(?: licen[sc]e)?(?:,? v(?:ersion|er)?\.? ?[0-9]++(?:\.[0-9]++)*+)?(?:-only|-or-later|\+| or(?: \(?at your option\)? any)? later)?(?![a-z0-9])(?!\.[0-9])"
#: Fixed values. Sentences of license texts: pattern, keyword, label; priority 5.
SENTENCES = [
    (r"permission is hereby granted, free of charge, to any person obtaining a copy", "granted", "mit"),
    (r"the above copyright notice and this permission notice shall be included in all copies", "permission", "mit"),
    (r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose", "permission", "isc"),
    (r"permission to use, copy, modify, and distribute this software and its documentation", "permission", "hpnd"),
    (r"redistribution and use in source and binary forms,? with or without modification", "redistribution", "bsd"),
    (r"redistributions in binary form must reproduce the above copyright notice", "redistributions", "bsd"),
    (r"redistributions of source code must retain the above copyright notice", "redistributions", "bsd"),
    (r"neither the names? of (?:(?!neither the name).)++", "neither", "bsd-3-clause"),
    (r"all advertising materials mentioning features or use of this software must display", "advertising", "bsd-4-clause"),
    (r"this program is free software[;:] you can redistribute it", "free", "gpl"),
    (r"this (?:program|file|software) is distributed in the hope that it will be useful", "hope", "gpl"),
    (r"this library is free software[;:] you can redistribute it", "free", "lgpl"),
    (r"this library is distributed in the hope that it will be useful", "hope", "lgpl"),
    (r"under the terms of version 2 of the gnu general public licen[sc]e", "general", "gpl-2.0"),
    (r"under the terms of version 3 of the gnu general public licen[sc]e", "general", "gpl-3.0"),
    (r"either version 2 of the licen[sc]e, or \(at your option\) any later version", "either", "gpl-2.0"),
    (r"either version 2\.1 of the licen[sc]e, or \(at your option\) any later version", "either", "lgpl-2.1"),
    (r"either version 3 of the licen[sc]e, or \(at your option\) any later version", "either", "gpl-3.0"),
    (r"you may not use this file except in compliance with the licen[sc]e", "compliance", "apache-2.0"),
    (r"to you under the apache licen[sc]e", "apache", "apache"),
    (r"unless required by applicable law or agreed to in writing, software distributed under the licen[sc]e", "unless", "apache-2.0"),
    (r"this source code form is subject to the terms of the mozilla public licen[sc]e,? v(?:ersion|\.) ?2\.0", "mozilla", "mpl-2.0"),
    (r"the contents of this file are subject to the mozilla public licen[sc]e version 1\.1", "mozilla", "mpl-1.1"),
    (r"this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e", "eclipse", "epl"),
    (r"the contents of this file are subject to the terms of the common development and distribution licen[sc]e", "development", "cddl"),
    (r"this is free and unencumbered software released into the public domain", "unencumbered", "unlicense"),
    (r"(?:dedicated to|released into|placed in|placed into) the public domain", "domain", "public-domain"),
    (r"has dedicated the work to the public domain by waiving", "waiving", "cc0"),
    (r"this software is provided ['\"]?as~is['\"]?, without any express or implied warranty", "express", "zlib"),
    (r"altered source versions must be plainly marked as such", "altered", "zlib"),
    (r"permission is hereby granted, free of charge, to any person or organization obtaining a copy", "organization", "boost-1.0"),
    (r"everyone is permitted to copy and distribute verbatim copies of this licen[sc]e document", "verbatim", "gpl"),
    (r"you just do what the fuck you want to", "fuck", "wtfpl"),
    (r"this software is copyrighted by the regents of the university of california", "regents", "tcl"),
    (r"in no event shall the university of california be liable to any party", "california", "postgresql"),
    (r"this product includes software developed by the openssl project", "openssl", "openssl"),
    (r"this font software is licensed under the sil open font licen[sc]e", "font", "ofl"),
    (r"you are free to share (?:-|--|:)? ?copy and redistribute the material", "share", "cc-by"),
    (r"you may not use the material for commercial purposes", "commercial", "cc-by-nc"),
    (r"use of this source code is governed by a bsd-style licen[sc]e", "bsd-style", "bsd"),
    (r"use of this source code is governed by an mit-style licen[sc]e", "mit-style", "mit"),
    (r"all rights reserved", "reserved", "proprietary"),
    (r"this software is (?:the )?(?:confidential and )?proprietary", "proprietary", "proprietary"),
]
#: Names that are words of other subjects: alone, "license" must end the phrase or be followed by a version.
AMBIGUOUS = ("ruby", "vim", "php", "tcl", "elastic")
#: Keywords that are no plain text: what they stand for may be wrapped.
WRAPPED = {"cc-by": "cc~by"}


def written(pattern: str) -> str:
    """A rule's regex, with its blanks written out."""
    return pattern.replace("~", "(?:" + GAP + "|-)").replace(" ?", "(?:" + GAP + ")?").replace(" ", GAP)


def passes() -> list[tuple[int, str, str, str, bool]]:
    """(pass, keyword, pattern, label, whether it is a name): all forms of a name are one pass."""
    out = []
    for label, name, keyword, versioned in NAMES:
        before = [f for f, _, _ in FORMS if f]
        # a name alone, or after "subject to", needs the word
        need = "" if versioned else r"(?= licen[sc]e(?![a-z]))" if label not in AMBIGUOUS else r"(?= licen[sc]e(?:,? v(?:ersion|er)?\.? ?[0-9]| ?[.,;:)]| ?$))"
        free = "|".join(f for k, f in enumerate(before) if k != 3)
        out.append((keyword, rf"(?<![a-z0-9])(?:(?:{free}){name}|(?:{before[3]})?{name}{need}){AFTER}", label, True))
    out += [(keyword, rf"(?<![a-z0-9]){pattern}", label, False) for pattern, keyword, label in SENTENCES]
    return [(i, keyword, written(pattern), label, named) for i, (keyword, pattern, label, named) in enumerate(out)]


def n_rules() -> int:
    """Rules in all: each name in each form, and the sentences."""
    return len(NAMES) * len(FORMS) + len(SENTENCES)


def scan(docs: DataFrame) -> DataFrame:
    """A row per document row: row, doc_id, n_words, n_base, first_word, last_word, base_labels, labels
    (sorted arrays), detections (array of start, end, label, score), score."""
    rules: dict[str, list] = {}
    for rule in passes():
        rules.setdefault(rule[1], []).append(rule)
    text = F.coalesce(column(docs, "text", "string"), F.lit(""))
    # the built-in lower-casing is the faster one and leaves no keyword out; a base phrase holds one, too
    held = lambda k: F.col("any").rlike(written(WRAPPED[k])) if k in WRAPPED else F.contains(F.col("any"), F.lit(k))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), column(docs, "doc_id", "long").alias("doc_id"), text.alias("text")).withColumn("any", F.lower("text"))
    rows = rows.withColumn("found", F.array_compact(F.array(*[F.when(held(k), F.lit(k)) for k in sorted(rules)])))
    rows = rows.select("row", "doc_id", F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"), "found", F.when(F.size("found") > 0, ascii_lower(F.col("text"))).alias("low"))
    rows = rows.withColumn("line", F.concat(F.lit(" "), F.trim(F.regexp_replace("low", NOT_WORD, " ")), F.lit(" ")))
    quoted = lambda t: "'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'"

    def hits(source: str, rule: int, pattern: str, measure: str) -> str:
        """Matches of a pattern, which is a constant of the plan and so compiled once a task. As text, for the rules are
        many: a match's place, what stands between the last one and it, its own length, and itself."""
        both = f"arrays_zip(split({source}, {quoted(pattern)}, -1), regexp_extract_all({source}, {quoted(pattern)}, 0))"
        return f"filter(transform({both}, (z, i) -> struct({rule} AS rule, i AS pos, {measure.format('z.`0`')} AS lead, {measure.format('z.`1`')} AS own, z.`1` AS match)), x -> x.own IS NOT NULL)"

    none = "CAST(array() AS array<struct<rule:int,pos:int,lead:int,own:int,match:string>>)"
    spaces = "(length({0}) - length(replace({0}, ' ')))"  # of base phrases, pieces are measured in spaces: one stands before each word
    parts = [f"CASE WHEN contains(line, {quoted(p)}) THEN {hits('line', -1 - k, f'(?<= ){p}(?= )', spaces)} ELSE {none} END" for k, p in enumerate(BASE)]
    for keyword, own in sorted(rules.items()):
        tried = ", ".join(hits("low", i, pattern, "length({0})") for i, _, pattern, _, _ in own)
        parts.append(f"CASE WHEN array_contains(found, {quoted(keyword)}) THEN concat({tried}) ELSE {none} END")
    each = rows.select("row", "doc_id", "n_words", F.explode_outer(F.expr(f"concat({', '.join(parts)})")).alias("h")).select("row", "doc_id", "n_words", "h.*")
    told = lambda k: F.when(F.col("rule") >= 0, F.element_at(F.array(*[F.lit(r[k]) for r in passes()]), F.col("rule") + 1))
    form = F.coalesce(*[F.when(F.col("match").rlike("^(?:" + written(f) + ")"), k) for k, (f, _, _) in enumerate(FORMS)])
    each = each.select("row", "doc_id", "n_words", "rule", "pos", "lead", "own", told(3).alias("label"), F.when(told(4), form).alias("form")).repartition("row")
    of_form = lambda k, told: F.when(F.col("form").isNull(), told).otherwise(F.element_at(F.array(*[F.lit(f[k]) for f in FORMS]), F.col("form") + 1))
    each = each.withColumns({"priority": of_form(1, 5), "confidence": of_form(2, 0.95)})

    order = Window.partitionBy("row", "rule").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.when(F.col("own").isNotNull(), F.sum(F.col("lead").cast("long") + F.coalesce("own", F.lit(0))).over(order))
    each = each.withColumn("end", end).withColumn("start", F.col("end") - F.col("own"))
    signature = (F.col("rule") >= 0) & F.col("end").isNotNull()
    before = Window.partitionBy("row").orderBy(F.col("start").asc_nulls_first(), F.col("end").desc(), F.col("priority").desc(), "rule").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("row", "start", "end").orderBy(F.col("priority").desc(), "rule").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.lit(False)
    for p in range(1, 6):  # the furthest end so far, of each priority and above
        reach = F.max(F.when(signature & (F.col("priority") >= p), F.col("end"))).over(before)
        inside = F.when(F.col("priority") == p, F.coalesce(reach >= F.col("end"), F.lit(False))).otherwise(inside)
    each = each.withColumn("kept", signature & ~inside & (F.count("*").over(after) == 0))

    base_place = F.when((F.col("rule") < 0) & F.col("end").isNotNull(), F.col("start") - 1)
    base_label = F.element_at(F.array(*map(F.lit, BASE.values())), -F.col("rule"))
    return each.groupBy("row", "doc_id", "n_words").agg(
        F.count(base_place).alias("n_base"), F.min(base_place).alias("first_word"), F.max(base_place).alias("last_word"),
        F.array_sort(F.collect_set(F.when(base_place.isNotNull(), base_label))).alias("base_labels"),
        F.array_sort(F.array_union(F.collect_set(F.when(base_place.isNotNull(), base_label)), F.collect_set(F.when(F.col("kept"), F.col("label"))))).alias("labels"),
        F.array_sort(F.collect_list(F.when(F.col("kept"), F.struct("start", "end", "label", F.col("confidence").alias("score"))))).alias("detections"),
        F.greatest(F.coalesce(F.max(F.when(F.col("kept"), F.col("confidence"))), F.lit(0.0)), F.when(F.count(base_place) > 0, BASE_SCORE).otherwise(0.0)).alias("score"),
    )


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of the table."""
    found = scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")
