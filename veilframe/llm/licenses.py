"""Licence scans by sentence rules, in DataFrame functions only.

A text is cut into sentences, each normalised and looked up in a table of known licence sentences; the sequence of
their identifiers is then matched against ordered rules, each of which turns the identifiers it covers into a licence.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.functions.fold import let
from veilframe.functions.fold import scan as scan_array

# Sentences of public licence texts and notices in normal form (lower case, only letters, digits and the signs . + -).
SENTENCES = {
    "AllRights": "all rights reserved",
    "ApacheLic2": "licensed under the apache license, version 2.0",
    "ApacheLic2The": "licensed under the apache license, version 2.0 the license",
    "ApacheUse": "you may not use this file except in compliance with the license",
    "ApacheCopyAt": "you may obtain a copy of the license at http",
    "ApacheDist": "unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an as is basis, without warranties or conditions of any kind, either express or implied",
    "ApacheSee": "see the license for the specific language governing permissions and limitations under the license",
    "MITReleased": "released under the mit license",
    "MITLicensed": "licensed under the mit license",
    "MITPerm": "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files the software, to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, and to permit persons to whom the software is furnished to do so, subject to the following conditions",
    "MITNotice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "MITNoWarranty": "the software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement",
    "GPL3Work": "this work is licensed under the gnu general public license, version 3",
    "GPL2Work": "this work is licensed under the gnu general public license, version 2",
    "GPLFree": "this program is free software",
    "GPL2Later": "you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation",
    "GPLEither2": "either version 2 of the license, or at your option any later version",
    "GPLEither3": "either version 3 of the license, or at your option any later version",
    "GPLHope": "this program is distributed in the hope that it will be useful, but without any warranty",
    "GPLMerchant": "without even the implied warranty of merchantability or fitness for a particular purpose",
    "GPLSee": "see the gnu general public license for more details",
    "LGPLLicensed": "licensed under the gnu lesser general public license, version 3",
    "BSDRedist": "redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "BSDSource": "redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "BSDBinary": "redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "BSDEndorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "BSDDisclaim": "this software is provided by the copyright holders and contributors as is and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "BSDLiable": "in no event shall the copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or consequential damages including, but not limited to, procurement of substitute goods or services",
    "BSDLoss": "loss of use, data, or profits",
    "BSDBusiness": "or business interruption however caused and on any theory of liability, whether in contract, strict liability, or tort including negligence or otherwise arising in any way out of the use of this software, even if advised of the possibility of such damage",
    "ApacheTitle": "apache license version 2.0, january 2004",
    "ApacheTerms": "terms and conditions for use, reproduction, and distribution",
    "GPL2Title": "gnu general public license version 2, june 1991",
    "GPL3Title": "gnu general public license version 3, 29 june 2007",
    "GPL3Preamble": "the gnu general public license is a free, copyleft license for software and other kinds of works",
    "LGPL21Title": "gnu lesser general public license version 2.1, february 1999",
    "LGPL3Title": "gnu lesser general public license version 3, 29 june 2007",
    "AGPL3Title": "gnu affero general public license version 3, 19 november 2007",
    "LGPLFree": "this library is free software",
    "LGPLLater": "you can redistribute it and/or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
    "LGPLEither21": "either version 2.1 of the license, or at your option any later version",
    "LGPLHope": "this library is distributed in the hope that it will be useful, but without any warranty",
    "LGPLSee": "see the gnu lesser general public license for more details",
    "AGPLLater": "you can redistribute it and/or modify it under the terms of the gnu affero general public license as published by the free software foundation",
    "AGPLSee": "see the gnu affero general public license for more details",
    "EPL1": "this program and the accompanying materials are made available under the terms of the eclipse public license v1.0 which accompanies this distribution, and is available at",
    "EPL2": "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0 which is available at",
    "ISCPerm": "permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "MPL2Subject": "this source code form is subject to the terms of the mozilla public license, v. 2.0",
    "MPL2Licensed": "licensed under the mozilla public license, version 2.0",
    "CCBY": "licensed under cc by 4.0",
    "CCBYSA": "licensed under cc by-sa 4.0",
    "CCBYNC": "licensed under cc by-nc 4.0",
    "CCBYNCSA": "licensed under cc by-nc-sa 4.0",
    "CCWork": "this work is licensed under a creative commons attribution 4.0 international license",
    "CC0": "to the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "Unlicense": "this is free and unencumbered software released into the public domain",
}
_GPL = SENTENCES["GPL2Later"] + ", "
#: The sentences with the further forms that public texts give them: the address of a licence in a line of its own, or behind its
#: sentence; a comma for a semicolon. A key of several identifiers is a sentence that says them all.
KNOWN = {**SENTENCES, **{f"{terms} {either}": SENTENCES[terms] + ", " + SENTENCES[either] for terms, either in (
             ("LGPLLater", "LGPLEither21"), ("LGPLLater", "GPLEither3"), ("AGPLLater", "GPLEither3"))},
         **{name: (SENTENCES[name], *[f"{SENTENCES[name]} {web}://www.{at}" for web in ("http", "https")]) for name, at in (
             ("EPL1", "eclipse.org/legal/epl-v10.html"), ("EPL2", "eclipse.org/legal/epl-2.0"), ("ApacheTitle", "apache.org/licenses"))},
         "GPL2Later GPLEither2": _GPL + SENTENCES["GPLEither2"], "GPL2Later GPLEither3": _GPL + SENTENCES["GPLEither3"],
         "ApacheCopyAt": (SENTENCES["ApacheCopyAt"], "you may obtain a copy of the license at", *[
             f"you may obtain a copy of the license at {web}://www.apache.org/licenses/license-2.0{end}"
             for web in ("http", "https") for end in ("", ".txt", ".html")])}
# Fixed values, in order: the first rule that fits a place takes it; longer sequences stand before their parts.
RULES = [
    ("Apache-2.0", ["ApacheLic2The", "ApacheUse", "ApacheCopyAt", "ApacheDist", "ApacheSee"]),
    ("Apache-2.0", ["ApacheLic2The", "ApacheUse"]),
    ("Apache-2.0", ["ApacheLic2The"]),
    ("Apache-2.0", ["ApacheLic2"]),
    ("MIT", ["MITPerm", "MITNotice", "MITNoWarranty"]),
    ("MIT", ["MITPerm", "MITNotice"]),
    ("MIT", ["MITReleased"]),
    ("MIT", ["MITLicensed"]),
    ("Apache-2.0", ["ApacheTitle", "ApacheTerms"]),
    ("Apache-2.0", ["ApacheTitle"]),
    ("AGPL-3.0-or-later", ["GPLFree", "AGPLLater", "GPLEither3", "GPLHope", "GPLMerchant", "AGPLSee"]),
    ("AGPL-3.0-or-later", ["GPLFree", "AGPLLater", "GPLEither3"]),
    ("AGPL-3.0-only", ["AGPL3Title"]),
    ("LGPL-2.1-or-later", ["LGPLFree", "LGPLLater", "LGPLEither21", "LGPLHope", "GPLMerchant", "LGPLSee"]),
    ("LGPL-2.1-or-later", ["LGPLFree", "LGPLLater", "LGPLEither21"]),
    ("LGPL-3.0-or-later", ["LGPLFree", "LGPLLater", "GPLEither3", "LGPLHope", "GPLMerchant", "LGPLSee"]),
    ("LGPL-3.0-or-later", ["LGPLFree", "LGPLLater", "GPLEither3"]),
    ("LGPL-3.0-or-later", ["GPLFree", "LGPLLater", "GPLEither3", "GPLHope", "GPLMerchant", "LGPLSee"]),
    ("LGPL-3.0-or-later", ["GPLFree", "LGPLLater", "GPLEither3"]),
    ("LGPL-3.0-only", ["LGPL3Title"]),
    ("LGPL-2.1-only", ["LGPL21Title"]),
    ("GPL-3.0-only", ["GPL3Title", "GPL3Preamble"]),
    ("GPL-3.0-only", ["GPL3Title"]),
    ("GPL-2.0-only", ["GPL2Title"]),
    ("EPL-2.0", ["EPL2"]),
    ("EPL-1.0", ["EPL1"]),
    ("GPL-3.0-or-later", ["GPLFree", "GPL2Later", "GPLEither3", "GPLHope", "GPLMerchant", "GPLSee"]),
    ("GPL-3.0-or-later", ["GPLFree", "GPL2Later", "GPLEither3"]),
    ("GPL-2.0-or-later", ["GPLFree", "GPL2Later", "GPLEither2", "GPLHope", "GPLMerchant", "GPLSee"]),
    ("GPL-2.0-or-later", ["GPLFree", "GPL2Later", "GPLEither2"]),
    ("GPL-3.0-only", ["GPL3Work"]),
    ("GPL-2.0-only", ["GPL2Work"]),
    ("LGPL-3.0-only", ["LGPLLicensed"]),
    ("BSD-3-Clause", ["BSDRedist", "BSDSource", "BSDBinary", "BSDEndorse", "BSDDisclaim", "BSDLiable", "BSDLoss", "BSDBusiness"]),
    ("BSD-2-Clause", ["BSDRedist", "BSDSource", "BSDBinary", "BSDDisclaim", "BSDLiable", "BSDLoss", "BSDBusiness"]),
    ("BSD-3-Clause", ["BSDRedist", "BSDSource", "BSDBinary", "BSDEndorse"]),
    ("BSD-2-Clause", ["BSDRedist", "BSDSource", "BSDBinary"]),
    ("ISC", ["ISCPerm"]),
    ("MPL-2.0", ["MPL2Subject"]),
    ("MPL-2.0", ["MPL2Licensed"]),
    ("CC-BY-NC-SA-4.0", ["CCBYNCSA"]),
    ("CC-BY-NC-4.0", ["CCBYNC"]),
    ("CC-BY-SA-4.0", ["CCBYSA"]),
    ("CC-BY-4.0", ["CCBY"]),
    ("CC-BY-4.0", ["CCWork"]),
    ("CC0-1.0", ["CC0"]),
    ("Unlicense", ["Unlicense"]),
    ("LicenseRef-AllRightsReserved", ["AllRights"]),
]
#: Openings at which a line starts a sentence although the one before it has no end.
HEADS = ("licensed under|released under|this work is|all rights reserved|permission |redistribution|neither the name|copyright|"
         "this program is|this source code|to the extent possible|this is free|unless required|see the|you may")
LEADERS = "[ \\t]*(?://+|/\\*+|\\*+/|\\*+|#+|;+|--+|%+|<!--)?[ \\t]*"
CUT = "\x01"
_FOUND = "array<array<string>>"
MAYBE = "\x02"  # after a cut that may be none: the line may as well go on with the one before it


def _normal(text: Column) -> Column:
    """Lower case, quotes and brackets gone, other signs blanks, one blank between words and none before a comma or full stop."""
    low = F.regexp_replace(F.lower(text), "[^a-z0-9.,+/-]+", " ")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(low, "^[ .,/-]+|[ .,;:/-]+$", ""), " +", " "), " ([.,])", "$1")


def _pieces(text: Column) -> Column:
    """A text cut after . ; : ! ? before white space, at blank lines and before a line that begins like a known sentence; comment
    signs at line starts are dropped. A piece begins with MAYBE if it may belong to the one before it: a wrapped line can begin
    like a sentence, and the full stop of "v. 2" ends none."""
    plain = F.regexp_replace(F.translate(text, CUT + MAYBE, "\x03\x03"), "\\r\\n?", "\n")
    plain = F.regexp_replace(F.concat(F.lit("\n"), plain), "\\n" + LEADERS, "\n")
    cut = F.regexp_replace(plain, "(?i)(\\bv\\.)[ \\t\\n\\f]+(?=[0-9])", "$1" + CUT + MAYBE)
    cut = F.regexp_replace(cut, "([.;:!?])[ \\t\\n\\f]+", "$1" + CUT)
    cut = F.regexp_replace(cut, "\\n[ \\t]*\\n", CUT)
    cut = F.regexp_replace(cut, "(?i)\\n(" + HEADS + ")", CUT + MAYBE + "$1")
    return F.split(cut, CUT, -1)


def _most_pieces(known: Iterable[str]) -> int:
    """The most pieces that a known sentence in normal form can be cut into."""
    return 1 + max((len(re.findall(f" (?:{HEADS})|\\bv\\. (?=[0-9])", s)) for s in known), default=0)


def hint(known: Iterable[str]) -> str:
    """A pattern of single words, of which every known sentence in normal form has one; other texts cannot match.

    Letters and digits of a word stand together in the raw text too, whatever signs and line ends are around it. A
    sentence without a word lets every text through.
    """
    left = [set(re.findall("[a-z0-9]+", s)) for s in known]
    if not all(left):
        return ""
    left = [{w for w in words if len(w) >= min(7, max(map(len, words)))} for words in left]  # few other texts have long words
    out = []
    while left:
        out.append(min(set.union(*left), key=lambda w: (-sum(w in words for words in left), -len(w), w)))
        left = [words for words in left if out[-1] not in words]
    return "|".join(out)


def identifiers(text: Column, known: dict[str, str | tuple[str, ...]] = KNOWN) -> Column:
    """Identifiers of the known sentences of a text, in order; none for a null text.

    Where a cut may be none, neighbouring pieces are looked up together first, the longest run that is known, then each by itself.
    """
    forms = _by_sentence(known)
    table = F.create_map(*[x for s, names in forms.items() for x in (F.lit(s), F.array(*map(F.lit, names.split())))])
    most = _most_pieces(forms)

    def known_run(p, i, n):
        """What n pieces from the i-th on say, if they may be one sentence."""
        joined = F.concat(*[F.get(p, i + k) for k in range(n)])  # null beyond the end
        fits = [F.startswith(F.get(p, i + k), F.lit(MAYBE)) for k in range(1, n)]
        said = F.try_element_at(table, _normal(joined))
        return F.when(reduce(Column.__and__, fits), said) if fits else said

    def found_at(p, i, n):
        """(number of pieces, identifiers) of the longest known run of up to n pieces from the i-th on."""
        shorter = found_at(p, i, n - 1) if n > 1 else F.lit(None)
        return let(known_run(p, i, n), lambda said: F.when(said.isNotNull(), F.struct(F.lit(n).alias("n"), said.alias("ids"))).otherwise(shorter))

    def whole(p):
        return F.flatten(F.array_compact(F.transform(p, lambda x: F.try_element_at(table, _normal(x)))))

    def joined(p):
        at = F.transform(p, lambda _, i: found_at(p, i, most))
        zero = F.struct(F.lit(0).alias("left"), F.array().cast(_FOUND).alias("out"))
        step = lambda acc, x: F.struct(
            F.when(acc["left"] > 0, acc["left"] - 1).otherwise(F.coalesce(x["n"], F.lit(1)) - 1).alias("left"),
            F.when((acc["left"] > 0) | x.isNull(), acc["out"]).otherwise(F.array_append(acc["out"], x["ids"])).alias("out"))
        return F.flatten(scan_array(at, zero, ["left"], _FOUND, step))

    found = let(_pieces(text), lambda p: F.when(F.exists(p, lambda x: F.startswith(x, F.lit(MAYBE))), joined(p)).otherwise(whole(p)))
    return F.when(F.coalesce(F.lower(text).rlike(hint(forms)), F.lit(False)), found).otherwise(F.array().cast("array<string>"))


def _plain(sentence: str) -> str:
    """_normal of a known sentence."""
    low = re.sub("^[ .,/-]+|[ .,;:/-]+$", "", re.sub("[^a-z0-9.,+/-]+", " ", sentence.lower()))
    return re.sub(" ([.,])", r"\1", re.sub(" +", " ", low))


def _by_sentence(known: dict[str, str | tuple[str, ...]]) -> dict[str, str]:
    """Identifiers by normal form; of equal forms the first one counts."""
    out: dict[str, str] = {}
    for name, forms in known.items():
        for form in (forms,) if isinstance(forms, str) else forms:
            out.setdefault(_plain(form), name)
    return out


#: The hint of the built-in table.
HINT = hint(_by_sentence(KNOWN))


def match_rules(ids: Column, rules: list[tuple[str, list[str]]] = RULES) -> Column:
    """Licences in the order of the text: ordered rules rewrite the identifier sequence, what no rule takes is left out."""
    seq = F.array_join(F.transform(ids, lambda x: F.concat(F.lit("<"), x, F.lit(">"))), "")
    for licence, rule in rules:
        seq = F.replace(seq, F.lit("".join(f"<{x}>" for x in rule)), F.lit(f"{{{licence}}}"))
    return F.regexp_extract_all(seq, F.lit("\\{([^}]*)\\}"), F.lit(1))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: dict[str, str | tuple[str, ...]] = KNOWN,
         rules: list[tuple[str, list[str]]] = RULES) -> DataFrame:
    """(id, sentence_ids array, licences array), one row per row of docs, without a shuffle.

    Null and empty texts have two empty arrays; repeated rows repeat; a licence that is stated twice is listed twice.
    """
    found = docs.select(F.col(id_col).alias("id"), identifiers(F.col(text_col), known).alias("sentence_ids"))
    return found.withColumn("licences", match_rules(F.col("sentence_ids"), rules))
