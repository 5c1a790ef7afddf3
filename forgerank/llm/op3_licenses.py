"""Licence scans by sentence rules, on DataFrame functions only.

A text is normalised (lower case, letters and digits) and cut into sentences, at sentence
punctuation and blank lines, and these into clauses, at commas, colons, brackets and line
breaks. Clauses that follow each other in a sentence and together have the words of a known
licence sentence are mapped to its identifier, so line breaks, comment markers, brackets and
what a sentence goes on with do not hide it. The identifiers of a text, in order, form a
sequence in which up to ``GAP`` sentences without a known one between two known ones are
overlooked and a longer stretch is a break; numbers of lists are no sentences. Ordered rules
are then matched against the sequence: a rule is a run of identifiers, the more specific
rules come first, and what a rule has matched is consumed. A licence in ``ALONE`` counts only
where no other is found: "all rights reserved" in another licence's copyright line says nothing.

A name may stand where a sentence has the copyright holder's (``HOLDER``), with an end of a
sentence in it ("Inc."). An SPDX tag with several operands, all of them known, is a sentence an
operand; exceptions after "with" are overlooked. Sentences and rules are parameters.

The SQL of this query looks sentences up line by line, cut at brackets as well. It agrees
where every known sentence stands on a line of its own, as in the given tables.

Texts without any of the words in ``MAYBE`` have no known sentence and are not cut. Every
text is scanned where it lies: no shuffle.

Defined results: null and empty texts have no licences, which is an empty map as in any text without; a rule that matches several times
counts each time; known sentences that no rule takes are counted as unmatched; repeated
rows and null ids keep their rows; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# FIXED VALUES: known licence sentences, normalised. The identifiers are two letters.
SENTENCES = {
    "licensed under the apache license version 2 0": "aa",
    "you may not use this file except in compliance with the license": "ac",
    "you may obtain a copy of the license at": "ad",
    "http www apache org licenses license 2 0": "ae",
    "spdx license identifier apache 2 0": "as",
    "this work is licensed under the gnu general public license version 3": "ga",
    "this program is free software": "gb",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gc",
    "either version 3 of the license or at your option any later version": "gd",
    "either version 2 of the license or at your option any later version": "ge",
    "this program is distributed in the hope that it will be useful but without any warranty": "gf",
    "licensed under the gnu general public license version 2": "gg",
    "licensed under the gnu general public license version 3": "gh",
    "spdx license identifier gpl 3 0 only": "gs",
    "spdx license identifier gpl 2 0 only": "gt",
    "licensed under the gnu lesser general public license version 3": "la",
    "licensed under the mit license": "ma",
    "released under the mit license": "mb",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "mc",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "md",
    "the software is provided as is without warranty of any kind": "me",
    "spdx license identifier mit": "ms",
    "licensed under the bsd 3 clause license": "ba",
    "licensed under the bsd 2 clause license": "bb",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bc",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bd",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "be",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation": "va",
    "this library is free software": "lb",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation": "lc",
    "either version 2 1 of the license or at your option any later version": "ld",
    "this library is distributed in the hope that it will be useful but without any warranty": "lf",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ia",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "ib",
    "spdx license identifier agpl 3 0 only": "xa",
    "spdx license identifier agpl 3 0 or later": "xb",
    "spdx license identifier gpl 2 0 or later": "xc",
    "spdx license identifier gpl 3 0 or later": "xd",
    "spdx license identifier lgpl 2 1 only": "xe",
    "spdx license identifier lgpl 2 1 or later": "xf",
    "spdx license identifier lgpl 3 0 only": "xg",
    "spdx license identifier lgpl 3 0 or later": "xh",
    "spdx license identifier bsd 2 clause": "xi",
    "spdx license identifier bsd 3 clause": "xj",
    "spdx license identifier isc": "xk",
    "spdx license identifier mpl 2 0": "xl",
    "spdx license identifier epl 2 0": "xm",
    "spdx license identifier unlicense": "xn",
    "spdx license identifier bsl 1 0": "xo",
    "spdx license identifier cc0 1 0": "xp",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "pa",
    "licensed under cc by 4 0": "ca",
    "licensed under cc by sa 4 0": "cb",
    "licensed under cc by nc 4 0": "cc",
    "licensed under cc by nd 4 0": "cd",
    "licensed under cc by nc sa 4 0": "ce",
    "licensed under cc by nc nd 4 0": "cf",
    "licensed under cc0 1 0": "cg",
    "all rights reserved": "ra",
}
# FIXED VALUES: the rules in the order in which they are tried.
RULES = [
    (["aa", "ac", "ad", "ae"], "Apache-2.0"), (["aa", "ac"], "Apache-2.0"),
    (["aa"], "Apache-2.0"), (["as"], "Apache-2.0"),
    (["gb", "va", "gd", "gf"], "AGPL-3.0-or-later"), (["va", "gd"], "AGPL-3.0-or-later"),
    (["lb", "lc", "ld", "lf"], "LGPL-2.1-or-later"), (["lc", "ld"], "LGPL-2.1-or-later"),
    (["gb", "lc", "gd", "gf"], "LGPL-3.0-or-later"), (["lb", "lc", "gd", "lf"], "LGPL-3.0-or-later"),
    (["lc", "gd"], "LGPL-3.0-or-later"), (["ia", "ib"], "ISC"), (["ia"], "ISC"),
    (["xa"], "AGPL-3.0-only"), (["xb"], "AGPL-3.0-or-later"), (["xc"], "GPL-2.0-or-later"), (["xd"], "GPL-3.0-or-later"),
    (["xe"], "LGPL-2.1-only"), (["xf"], "LGPL-2.1-or-later"), (["xg"], "LGPL-3.0-only"), (["xh"], "LGPL-3.0-or-later"),
    (["xi"], "BSD-2-Clause"), (["xj"], "BSD-3-Clause"), (["xk"], "ISC"), (["xl"], "MPL-2.0"), (["xm"], "EPL-2.0"),
    (["xn"], "Unlicense"), (["xo"], "BSL-1.0"), (["xp"], "CC0-1.0"),
    (["gb", "gc", "gd", "gf"], "GPL-3.0-or-later"), (["gc", "gd"], "GPL-3.0-or-later"),
    (["gb", "gc", "ge", "gf"], "GPL-2.0-or-later"), (["gc", "ge"], "GPL-2.0-or-later"),
    (["ga"], "GPL-3.0-only"), (["gh"], "GPL-3.0-only"), (["gs"], "GPL-3.0-only"),
    (["gg"], "GPL-2.0-only"), (["gt"], "GPL-2.0-only"), (["la"], "LGPL-3.0-only"),
    (["mc", "md", "me"], "MIT"), (["mc", "md"], "MIT"), (["ma"], "MIT"), (["mb"], "MIT"), (["ms"], "MIT"),
    (["bc", "bd", "be"], "BSD-3-Clause"), (["bc", "bd"], "BSD-2-Clause"),
    (["ba"], "BSD-3-Clause"), (["bb"], "BSD-2-Clause"), (["pa"], "MPL-2.0"),
    (["ca"], "CC-BY-4.0"), (["cb"], "CC-BY-SA-4.0"), (["cc"], "CC-BY-NC-4.0"), (["cd"], "CC-BY-ND-4.0"),
    (["ce"], "CC-BY-NC-SA-4.0"), (["cf"], "CC-BY-NC-ND-4.0"), (["cg"], "CC0-1.0"),
    (["ra"], "Proprietary"),
]
ALONE = ["Proprietary"]
# The sentence with a holder's name in it: what stands before and after the name, in the known one.
HOLDER = ("neither the name of", "the copyright holder", "nor the names of its contributors")
MAYBE = "(?i)licen[sc]|permission|redistribut|copyright|warrant|apache|free software|rights reserved"
SENTENCE_END = r"[.;:!?]+[ \t]+|[.;:!?]*[\r\n]+|[.;:!?]+$|\(|\)"  # of the SQL
GAP = 2
# Ends of sentences (not after the "v." of a version) and of clauses, in lower-case text.
HARD = r"(?<![^a-z0-9]v)[.;!?](?=[ \t\r\n]|\z)|(?:\r\n?+|\n)[^a-z0-9\r\n]*(?=[\r\n])"
SOFT = r"[.;:!?](?=[ \t\r\n]|\z)|[(),\r\n]"
# Where ends are ``H`` and ``S``: a holder's name of up to ten words.
NAMED = "(?<=[HS])" + HOLDER[0].replace(" ", "[ S]") + "[ S](?:[a-z0-9]+[ SH]){1,10}?(?=" + HOLDER[2].replace(" ", "[ S]") + ")"
OPERANDS = 8  # that a tag is read to


def _known(sentences: dict[str, str]) -> str:
    """Known sentences, from one end to another, with any clauses within."""
    return "(?<=[HS])(?:" + "|".join(s.replace(" ", "[ S]") for s in sorted(sentences, key=len, reverse=True)) + ")(?=[HS])"


def _tags(sentences: dict[str, str]) -> tuple[str, str]:
    """(an operand of a tag before another one, a tag's exception), in tags with known operands only."""
    head = "spdx license identifier "
    names = sorted((x[len(head):] for x in sentences if x.startswith(head)), key=len, reverse=True) or ["$."]
    tag, name, exception = head.replace(" ", "[ S]"), "(?:" + "|".join(names) + ")", "[ S]with[ S][a-z0-9 ]+?"
    link = f"(?:{exception})?[ S](?:and|or)[ S]"
    return f"((?<=[HS]){tag})({name}){link}(?=(?:{name}{link})*{name}(?:{exception})?[HS])", f"((?<=[HS]){tag}{name}){exception}(?=[HS])"


def identifiers(text: Column, sentences: dict[str, str] = SENTENCES) -> Column:
    """The text's sequence: known sentences as ``<id>``, breaks as ``|``."""
    t = F.lower(text)
    for pattern, mark in ((HARD, "H"), (SOFT, "S"), ("[^a-z0-9HS]+", " "), (" ?S[ S]*", "S"), ("[ S]?H[ SH]*", "H")):
        t = F.regexp_replace(t, pattern, mark)
    t = F.regexp_replace(F.concat(F.lit("H"), F.trim(t), F.lit("H")), NAMED, f"{HOLDER[0]} {HOLDER[1]} ")
    tag, (operand, exception) = t, _tags(sentences)
    for _ in range(OPERANDS - 1):
        tag = F.regexp_replace(tag, operand, "$1$2H$1")
    t = F.when(F.contains(t, F.lit("spdx")), F.regexp_replace(tag, exception, "$1")).otherwise(t)
    t = F.regexp_replace(t, _known(sentences), "K$0L")
    # The rest of a sentence with a known one in it is no sentence of its own.
    t = F.regexp_replace(F.regexp_replace(t, "L[a-z0-9 S]+", "L"), "H[a-z0-9 S]+K", "HK")
    known = F.create_map(*[F.lit(x) for pair in sentences.items() for x in pair])
    marks = F.transform(F.split(t, "H|(?=K)|(?<=L)"), lambda s: F.when(
        s.startswith("K"), F.concat(F.lit("<"), known[F.translate(s, "SKL", " ")], F.lit(">"))).when(
        s.rlike("^(?:[0-9]{0,3}|[a-z]|[ivx]{1,5})$"), "").otherwise("."))
    joined = F.concat_ws("", marks)
    return F.translate(F.regexp_replace(joined, rf"\.{{{GAP + 1},}}", "|"), ".", "")


def scan_licenses(docs: DataFrame, keep: list[str], text: str = "text", sentences: dict[str, str] = SENTENCES,
                  licence_rules: list[tuple[list[str], str]] = RULES, maybe: str = MAYBE) -> DataFrame:
    """``keep``, ``licenses`` (name to matches), ``n_sentences`` known and ``n_unmatched``."""
    t = F.coalesce(F.col(text), F.lit(""))
    maybe = maybe.replace(" ", "[^a-z0-9]+")  # words may lie on two lines
    df = docs.select(*keep, F.when(t.rlike(maybe), identifiers(t, sentences)).otherwise("").alias("seq0"))
    known = F.length(F.translate("seq0", "|>abcdefghijklmnopqrstuvwxyz", "")).cast("long")
    # Only sequences that are not empty are matched; each rule's matches are taken out before the next.
    acc = F.struct(F.col("seq0").alias("seq"), F.expr("cast(array() as array<struct<name:string,n:int>>)").alias("hits"))
    rules = F.array(*[F.struct(F.lit("".join(f"<{i}>" for i in ids)).alias("run"), F.lit(name).alias("name"))
                      for ids, name in licence_rules])

    def step(a, r):
        rest = F.replace(a["seq"], r["run"], F.lit("*"))  # a mark, so that nothing new comes together
        n = ((F.length(a["seq"]) - F.length(rest)) / (F.length(r["run"]) - 1)).cast("int")
        return F.when(n > 0, F.struct(rest.alias("seq"), F.array_append(a["hits"], F.struct(
            r["name"].alias("name"), n.alias("n"))).alias("hits"))).otherwise(a)

    df = df.select(*keep, "seq0", known.alias("n_sentences"),
                   F.when(F.col("seq0").contains("<"), F.aggregate(rules, acc, step)).alias("r"))
    left = F.coalesce(F.length(F.translate("r.seq", "*|>abcdefghijklmnopqrstuvwxyz", "")), F.lit(0)).cast("long")
    names = F.array_sort(F.array_distinct(F.transform("r.hits", lambda h: h["name"])))
    others = F.array_except(names, F.array(*map(F.lit, ALONE)))
    names = F.when(F.size(others) > 0, others).otherwise(names)
    counts = F.transform(names, lambda n: F.struct(n.alias("key"), F.aggregate(
        "r.hits", F.lit(0), lambda s, h: s + F.when(h["name"] == n, h["n"]).otherwise(0)).alias("value")))
    none = F.expr("cast(map() as map<string,int>)")
    return df.select(*keep, F.coalesce(F.map_from_entries(counts), none).alias("licenses"), "n_sentences", left.alias("n_unmatched"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan_licenses(table(spark, sf_dir, "documents"), ["doc_id"])
    text = F.concat_ws(",", F.transform(F.map_entries("licenses"), lambda e: F.concat(
        e["key"], F.lit(":"), e["value"].cast("string"))))
    return out.select("doc_id", text.alias("licenses"), "n_sentences", "n_unmatched")


def _duck() -> str:
    known = "MAP {" + ", ".join(f"'{s}': '<{i}>'" for s, i in SENTENCES.items()) + "}"
    steps, prev = [], "q0"
    for k, (ids, _) in enumerate(RULES):
        run = "".join(f"<{i}>" for i in ids)
        steps.append(f"q{k + 1} AS (SELECT *, replace(s{k}, '{run}', '*') AS s{k + 1}, "
                     f"(length(s{k}) - length(replace(s{k}, '{run}', '*'))) // {len(run) - 1} AS n{k} FROM {prev})")
        prev = f"q{k + 1}"
    names = sorted({n for _, n in RULES})
    total = {n: " + ".join(f"n{k}" for k, (_, m) in enumerate(RULES) if m == n) for n in names}
    other = " + ".join(t for n, t in total.items() if n not in ALONE)
    parts = ", ".join(f"CASE WHEN {t} > 0" + (f" AND {other} = 0" if n in ALONE else "") + f" THEN '{n}:' || ({t}) END" for n, t in total.items())
    named = f"'^{HOLDER[0]} (?:[a-z0-9]+ ){{1,10}}?{HOLDER[2]}', '{' '.join(HOLDER)}'"
    last = f"s{len(RULES)}"
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    x AS (SELECT doc_id, CASE WHEN regexp_matches(t, '{MAYBE}') THEN
            list_filter(list_transform(list_filter(string_split_regex(t, '{SENTENCE_END}'), lambda s: s <> ''),
              lambda s: regexp_replace(trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')), {named})), lambda s: s <> '') ELSE [] END AS l FROM d),
    q0 AS (SELECT doc_id, replace(regexp_replace(array_to_string(
             list_transform(l, lambda s: coalesce({known}[s], '.')), ''), '\\.{{{GAP + 1},}}', '|', 'g'), '.', '') AS s0 FROM x),
    {", ".join(steps)}
    SELECT doc_id, concat_ws(',', {parts}) AS licenses,
           (length(s0) - length(replace(s0, '<', '')))::BIGINT AS n_sentences,
           (length({last}) - length(replace({last}, '<', '')))::BIGINT AS n_unmatched
    FROM {prev}"""


QUERIES = {"op3_licenses": op3_licenses}
ORACLE = {"op3_licenses": _duck()}
