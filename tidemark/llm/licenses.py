"""License scan: sentences to identifiers, sequences of identifiers to rules. Spark expressions only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_of

# Normalised sentences (lower case, one space between runs of letters and digits) of well-known notices.
SENTENCES = {
    "mit-name": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-title": "the mit license",
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions"
    ),
    "mit-notice": (
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the software"
    ),
    "apache-name": "licensed under the apache license version 2 0",
    "apache-grant": "licensed under the apache license version 2 0 the license",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "gpl3-name": "this work is licensed under the gnu general public license version 3",
    "gpl3-program": "this program is licensed under the gnu general public license version 3",
    "gpl-free": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version 3 of the license or at your option "
        "any later version"
    ),
    "gpl-hope": (
        "this program is distributed in the hope that it will be useful but without any warranty without even the "
        "implied warranty of merchantability or fitness for a particular purpose"
    ),
    "gpl-copy": (
        "you should have received a copy of the gnu general public license along with this program"
    ),
    "bsd-grant": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met"
    ),
    "bsd-source": (
        "redistributions of source code must retain the above copyright notice this list of conditions and the following "
        "disclaimer"
    ),
    "cc-by-nc-4": "licensed under cc by nc 4 0",
    "cc-by-4": "licensed under cc by 4 0",
    "cc-by-sa-4": "licensed under cc by sa 4 0",
    "cc-by-work": "this work is licensed under a creative commons attribution 4 0 international license",
    "reserved": "all rights reserved",
}
# A rule holds when its sentences occur in this order; other sentences may lie between.
RULES = {
    "MIT": [["mit-name"], ["mit-licensed"], ["mit-title", "mit-grant"], ["mit-grant", "mit-notice"]],
    "Apache-2.0": [["apache-name"], ["apache-grant", "apache-use", "apache-copy"]],
    "GPL-3.0": [["gpl3-name"], ["gpl3-program"], ["gpl-free", "gpl-hope", "gpl-copy"]],
    "BSD": [["bsd-grant", "bsd-source"]],
    "CC-BY-NC-4.0": [["cc-by-nc-4"]],
    "CC-BY-4.0": [["cc-by-4"], ["cc-by-work"]],
    "CC-BY-SA-4.0": [["cc-by-sa-4"]],
    "All-rights-reserved": [["reserved"]],
}


def _normalised(text: Column) -> Column:
    """Lower case; ends of sentences are \\x01, lines stay, every other run without letters and digits is a space."""
    ended = F.regexp_replace(text, r"[.!?;:]+([\x20\x09-\x0D]|\z)", "\x01$1")
    return F.regexp_replace(F.lower(ended), r"[^\p{L}\p{N}\n\x01]+", " ")


def scan(
    docs: DataFrame, text: str = "text", key: str = "doc_id",
    sentences: Mapping[str, str] = SENTENCES, rules: Mapping[str, Sequence[Sequence[str]]] = RULES,
) -> DataFrame:
    """One row per row: ``doc_id``, ``line_ids``, ``sentence_ids``, ``licenses``, each joined by commas.

    Whole texts are cut twice, at lines and ends of sentences and at ends of sentences only, as notices stand on a line
    of their own or run over several. Each cut gives the identifiers of its known sentences in order (repeats count); a
    rule holds when either sequence has it. Null and empty texts have none. No rows in, no rows out; repeated rows are
    scanned alike; other columns are not read. The registry is a parameter of fixed size.
    """
    known = F.array(*[F.lit(s) for s in sentences.values()])
    ids = F.create_map(*[x for name, s in sentences.items() for x in (F.lit(s), F.lit(name))])
    norm = docs.select(F.col(key).cast("bigint").alias("doc_id"), _normalised(text_of(text)).alias("norm"))
    cut = norm.select(
        "doc_id",
        F.split("norm", r" ?[\n\x01][ \n\x01]*", -1).alias("lines"),
        F.split(F.regexp_replace("norm", r"[ \n]+", " "), r" ?\x01[ \x01]*", -1).alias("units"),
    )

    def found(column: str) -> Column:
        trimmed = F.transform(column, lambda s: F.trim(s))
        hits = F.filter(trimmed, lambda s: F.array_contains(known, s))
        # Most texts have no known sentence; that is seen by hash.
        some = F.arrays_overlap(trimmed, known)
        return F.when(some, F.transform(hits, lambda s: ids[s])).otherwise(F.array().cast("array<string>"))

    named = cut.select("doc_id", found("lines").alias("line_list"), found("units").alias("unit_list"))

    def holds(sequence: str, rule: Sequence[str]) -> Column:
        wanted = F.array(*map(F.lit, rule))
        step = lambda n, x: F.when(F.get(wanted, n).eqNullSafe(x), n + 1).otherwise(n)
        return F.aggregate(sequence, F.lit(0), step) == len(rule)

    def license_of(name: str) -> Column:
        any_rule = F.lit(False)
        for rule in rules[name]:
            any_rule = any_rule | holds("line_list", rule) | holds("unit_list", rule)
        return F.when(any_rule, F.lit(name))

    licenses = F.array_join(F.array_compact(F.array(*[license_of(n) for n in sorted(rules)])), ",")
    some = (F.size("line_list") > 0) | (F.size("unit_list") > 0)
    return named.select(
        "doc_id",
        F.array_join("line_list", ",").alias("line_ids"),
        F.array_join("unit_list", ",").alias("sentence_ids"),
        F.when(some, licenses).otherwise("").alias("licenses"),
    )


def scan_sql() -> str:
    """The scan in DuckDB SQL, from the same registry: rules as patterns over the joined identifiers."""
    quoted = ", ".join(f"'{s}'" for s in SENTENCES.values())
    names = ", ".join(f"'{s}': '{n}'" for n, s in SENTENCES.items())
    patterns = ", ".join(
        f"('{name}', '%{'%'.join(f'<{s}>' for s in rule)}%')" for name, many in RULES.items() for rule in many
    )
    return rf"""
with norm as (
  select doc_id, row_number() over () as r, regexp_replace(lower(regexp_replace(coalesce(text, ''),
    '[.!?;:]+([\x20\x09-\x0D]|\z)', chr(1) || '\1', 'g')), '[^\p{{L}}\p{{N}}\n\x01]+', ' ', 'g') as t from documents
), cut as (
  select doc_id, r, list_filter(list_transform(regexp_split_to_array(t, '[\n\x01]'), lambda x: trim(x)), lambda x: x in ({quoted})) as a,
    list_filter(list_transform(string_split(regexp_replace(t, '[ \n]+', ' ', 'g'), chr(1)), lambda x: trim(x)), lambda x: x in ({quoted})) as b
  from norm
), named as (
  select doc_id, r, list_transform(a, lambda x: map {{{names}}}[x]) as a, list_transform(b, lambda x: map {{{names}}}[x]) as b from cut
), hits as (
  select distinct r, name from named, (values {patterns}) p(name, pattern)
  where '<' || array_to_string(a, '><') || '>' like pattern or '<' || array_to_string(b, '><') || '>' like pattern
), grouped as (select r, string_agg(name, ',' order by name) as licenses from hits group by r)
select doc_id, array_to_string(a, ',') as line_ids, array_to_string(b, ',') as sentence_ids, coalesce(licenses, '') as licenses
from named left join grouped using (r)"""
