"""Licence texts recognised by sentence rules (operator 7).

A text is cut into sentences and normalised (lower case, words only). The known licence sentences are found among the cuts,
each over as many cuts and wrapped lines as it needs, from a cut's start to a cut's end; a licence is found where its rule's
sentence identifiers occur in the rule's order. All in DataFrame functions, row by row.

Defined results: a null or empty text has no sentences; repeated sentences are listed each time; an empty table gives no
row; columns of any name pass through. "or any later version" makes no difference to the licence's name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import bind

#: How a notice begins.
UNDER = "(?:re)?(?:licensed|leased|distributed|available|published|provided|offered) under (?:(?:a|an|the) )?(?:terms of (?:the )?)?"
CC = f"{UNDER}(?:%s|creative commons %s(?: international)?(?: public)?(?: licen[sc]e)?(?: %s)?)"
FSF = "(?: as published by the free software foundation)?"


def _cc(short: str, long: str) -> list[str]:
    return [CC % (f"{short} 4 0(?: international)?(?: licen[sc]e)?", f"{long} 4 0", f"{short} 4 0"), f"(?:creative commons )?{long} 4 0 international public license",
            f"spdx license identifier {short} 4 0"]


def _gnu(name: str, version: str, date: str, short: str, number: str) -> dict[str, list[str]]:
    v = f"(?: version| v| ver)? ?{version}(?: 0)?(?: or(?: at your option)? (?:any )?later(?: version)?| only)?"
    return {
        f"{short}{number}-notice": [f"{UNDER}gnu {name}(?: {short})?{v}", f"{UNDER}(?:gnu )?{short}{v}", f"spdx license identifier {short} {version}(?: 0)?(?: or later| only)?"],
        f"{short}{number}-title": [f"gnu {name} version {version} {date}"],
    }


#: Known licence sentences by identifier: patterns of normalised words, where a blank may also be a cut or a line's end.
SENTENCES = {
    "mit-notice": [f"{UNDER}(?:mit|expat|mit expat) licen[sc]e(?: mit)?", "spdx license identifier mit"],
    "mit-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software(?: and associated documentation files(?: the software)?)?"],
    "mit-condition": ["the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies(?: or substantial portions of the software)?"],
    "isc-notice": [f"{UNDER}isc licen[sc]e", "spdx license identifier isc"],
    "isc-grant": ["permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted"],
    "isc-condition": ["provided that the above copyright notice and this permission notice appear in all copies"],
    "apache-notice": [f"{UNDER}apache licen[sc]e (?:version |v )?2 0(?: the license)?", f"{UNDER}apache 2 0(?: licen[sc]e)?", "the asf licenses this file to you under the apache license version 2 0(?: the license)?",
                      "spdx license identifier apache 2 0"],
    "apache-condition": ["you may not use this file except in compliance with the license"],
    "apache-title": ["apache license version 2 0 january 2004"],
    "apache-terms": ["terms and conditions for use reproduction and distribution"],
    **_gnu("general public license", "3", "29 june 2007", "gpl", "3"), **_gnu("general public license", "2", "june 1991", "gpl", "2"),
    **_gnu("lesser general public license", "3", "29 june 2007", "lgpl", "3"), **_gnu("lesser general public license", "2 1", "february 1999", "lgpl", "2.1"),
    **_gnu("affero general public license", "3", "19 november 2007", "agpl", "3"),
    "gpl-notice": [f"{UNDER}(?:gnu )?(?:general public license|gpl)(?: gpl)?"],
    "gnu-verbatim": ["everyone is permitted to copy and distribute verbatim copies of this license document"],
    "gpl-free": ["(?:[a-z0-9]+ ){1,4}is free software"],
    "gpl-terms": [f"you can redistribute it and or modify it under the terms of the gnu general public license{FSF}"],
    "lgpl-terms": [f"you can redistribute it and or modify it under the terms of the gnu lesser general public license{FSF}"],
    "agpl-terms": [f"you can redistribute it and or modify it under the terms of the gnu affero general public license{FSF}"],
    "gnu-version-2": ["either version 2 of the license", "(?:under )?version 2 of the license"],
    "gnu-version-2.1": ["either version 2 1 of the license", "(?:under )?version 2 1 of the license"],
    "gnu-version-3": ["either version 3 of the license", "(?:under )?version 3 of the license"],
    "mpl-notice": ["this source code form is subject to the terms of the mozilla public license v 2 0", f"{UNDER}(?:mozilla public license|mpl) (?:version |v )?2 0", "spdx license identifier mpl 2 0"],
    "mpl-title": ["mozilla public license version 2 0"],
    "mpl-contributor": ["means each individual or legal entity that creates contributes to the creation of or owns covered software"],
    "cc-by-notice": _cc("cc by", "attribution"), "cc-by-sa-notice": _cc("cc by sa", "attribution share ?alike"), "cc-by-nd-notice": _cc("cc by nd", "attribution no ?deriv(?:ative)?s"),
    "cc-by-nc-notice": _cc("cc by nc", "attribution non ?commercial"), "cc-by-nc-sa-notice": _cc("cc by nc sa", "attribution non ?commercial share ?alike"),
    "cc-by-nc-nd-notice": _cc("cc by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s"),
    "cc0-notice": [f"{UNDER}cc0(?: 1 0)?(?: universal)?(?: licen[sc]e)?", "spdx license identifier cc0 1 0"],
    "cc0-title": ["(?:creative commons )?cc0 1 0 universal"],
    "cc0-statement": ["certain owners wish to permanently relinquish those rights to a work for the purpose of contributing to a commons of creative", "the person who associated cc0 with this work has waived all copyright and related or neighboring rights to this work"],
    "unlicense-grant": ["this is free and unencumbered software released into the public domain"],
    "unlicense-condition": ["anyone is free to copy modify publish use compile sell or distribute this software"],
    "reserved": ["all rights reserved"],
    "bsd-notice-2": [f"{UNDER}(?:bsd 2 clause|2 clause bsd|simplified bsd)(?: licen[sc]e)?", "spdx license identifier bsd 2 clause"],
    "bsd-notice-3": [f"{UNDER}(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd)(?: licen[sc]e)?", "spdx license identifier bsd 3 clause"],
    "bsd-grant": ["redistribution and use in source and binary forms(?: with or without modification)? are permitted(?: provided that the following conditions are met)?"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice(?: this list of conditions and the following disclaimer)?"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice(?: this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution)?"],
    "bsd-endorse": ["neither the names? of (?:[a-z0-9]+ ){1,24}?may be used to endorse or promote products derived from this software without (?:specific )?prior written permission"],
    "bsd-advertise": ["all advertising materials mentioning features or use of this software must display the following acknowledge?ment"],
}
#: Licence rules: (licence, sentence identifiers in order, identifiers that rule it out).
RULES = [
    ("MIT", ["mit-notice"], []), ("MIT", ["mit-grant", "mit-condition"], []),
    ("ISC", ["isc-notice"], []), ("ISC", ["isc-grant", "isc-condition"], []),
    ("Apache-2.0", ["apache-notice"], []), ("Apache-2.0", ["apache-notice", "apache-condition"], []), ("Apache-2.0", ["apache-title", "apache-terms"], []),
    ("GPL", ["gpl-notice"], []), ("GPL", ["gpl-free", "gpl-terms"], ["gnu-version-2", "gnu-version-3"]),
    *[(f"{short.upper()}-{number}{'' if '.' in number else '.0'}", ids, []) for short, number in (("gpl", "2"), ("gpl", "3"), ("lgpl", "2.1"), ("lgpl", "3"), ("agpl", "3"))
      for ids in ([f"{short}{number}-notice"], [f"{short}{number}-title", "gnu-verbatim"], ["gpl-free", f"{short}-terms", f"gnu-version-{number}"])],
    ("MPL-2.0", ["mpl-notice"], []), ("MPL-2.0", ["mpl-title", "mpl-contributor"], []),
    *[(f"CC-{kind}-4.0", [f"cc-{kind.lower()}-notice"], []) for kind in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND")],
    ("CC0-1.0", ["cc0-notice"], []), ("CC0-1.0", ["cc0-title", "cc0-statement"], []), ("CC0-1.0", ["cc0-statement"], []),
    ("Unlicense", ["unlicense-grant", "unlicense-condition"], []),
    ("BSD-2-Clause", ["bsd-notice-2"], []), ("BSD-3-Clause", ["bsd-notice-3"], []),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"], ["bsd-endorse", "bsd-advertise"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"], ["bsd-advertise"]),
    ("BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advertise", "bsd-endorse"], []),
    ("proprietary", ["reserved"], ["bsd-grant", "mit-grant", "isc-grant"]),
]
#: What may stand before a known sentence within its cut (a list's number, or the licensed thing), and after it.
LEAD_IN = "(?:[a-z0-9] )?(?:(?:(?:this|the|these|our|all) (?:source |example |original )?(?:projects?|software|works?|files?|programs?|library|packages?|repository|code|documents?|documentation|articles?|pages?|texts?|contents?|datasets?|data|modules?|tools?|book|material) (?:is|are)|it is) (?:also |hereby |made )?)?"
TAIL = "(?: (?:see|as found in|found in|which can be found in)(?: [a-z0-9]+){1,10}?)??"
#: A sentence ends at a line's end, or after one of these marks and white space.
SENTENCE_END = "\\n|(?<=[.;:!?,])\\s+"
#: Every known licence has one of these words; other texts are not cut.
HINT = "(?i)licen[sc]e|permission|redistribut|rights reserved|free software|copyright|public domain|creative commons|cc0|bsd|under (?:the |a )?(?:cc|creative|[al]?gpl|gnu|mpl|apache)"


def cuts(text: Column) -> Column:
    """A text's normalised words, with a bar at the start, the end and each cut."""
    marked = F.lower(F.regexp_replace(F.translate(text, "\x01", " "), SENTENCE_END, "\x01"))
    barred = F.regexp_replace(F.regexp_replace(marked, "[^a-z0-9\x01]+", " "), " ?\x01[\x01 ]*", " | ")
    return F.concat(F.lit("| "), F.trim(barred), F.lit(" |"))


def sentence_ids(text: Column) -> Column:
    """Identifiers of a text's known sentences, in order: each is put in its sentence's place, then all are read off."""
    def of(line: Column) -> Column:
        for name, patterns in SENTENCES.items():
            any_of = "|".join(f"(?:{x})" for x in patterns)
            whole = f"{LEAD_IN}(?:{any_of}){TAIL if '-notice' in name else ''}".replace(" ", " (?:\\| )?").replace("(?:\\| )??", "?")
            line = F.regexp_replace(line, f"(?<=\\| ){whole}(?= \\|)", f"#{name}#")
        return F.regexp_extract_all(line, F.lit("#([^#]+)#"), F.lit(1))

    return F.when(text.rlike(HINT), bind(cuts(text), of)).otherwise(F.array().cast("array<string>"))


def matched(ids: Column) -> Column:
    """Licences whose rule's identifiers occur in order, and none that rules it out, by name."""
    line = F.concat(F.lit(" "), F.array_join(ids, "  "), F.lit(" "))
    found = [
        F.when(line.rlike(".*".join(f" {_quoted(x)} " for x in rule)) & ~F.arrays_overlap(ids, F.array(*map(F.lit, unless)).cast("array<string>")), F.lit(name))
        for name, rule, unless in RULES]
    return F.array_sort(F.array_distinct(F.filter(F.array(*found), lambda x: x.isNotNull())))


def _quoted(identifier: str) -> str:
    return identifier.replace(".", "\\.")


def recognised(docs: DataFrame) -> DataFrame:
    """``docs`` with ``sentence_ids`` and ``licences``; a column of such a name is replaced."""
    rows = docs.withColumn("sentence_ids", F.coalesce(sentence_ids(F.col("text").cast("string")), F.array().cast("array<string>")))
    return rows.withColumn("licences", matched(F.col("sentence_ids")))
