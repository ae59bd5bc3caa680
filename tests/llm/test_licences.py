"""Licence rules on the public texts themselves, as their publishers wrap them."""

import pytest

from veilframe.llm import licenses

MIT = '''MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
'''
APACHE = '''Copyright 2020 Some One

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
'''
BSD = '''Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
'''
BSD3 = BSD + '''
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
'''
GPL = '''This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
'''
ISC = '''Copyright (c) 2020, Some One

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS.
'''
MPL = '''This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
'''
GPL2 = GPL.replace("software:", "software;").replace("Foundation,", "Foundation;").replace("version 3", "version 2")
GPL3 = GPL2.replace("version 2", "version 3")
GPL_IDS = ["GPLFree", "GPL2Later", None, "GPLHope", "GPLMerchant", "GPLSee"]
DISCLAIMER = '''
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR
ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON
ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
'''
DISCLAIMED = ["BSDDisclaim", "BSDLiable", "BSDLoss", "BSDBusiness"]
AGPL = GPL.replace("GNU General", "GNU Affero General")
LGPL = GPL.replace("GNU General", "GNU Lesser General").replace("This program", "This library").replace("version 3", "version 2.1")
LGPL_IDS = ["LGPLFree", "LGPLLater", "LGPLEither21", "LGPLHope", "GPLMerchant", "LGPLSee"]
EPL2 = '''Copyright (c) 2020 Some One

This program and the accompanying materials are made
available under the terms of the Eclipse Public License 2.0
which is available at https://www.eclipse.org/legal/epl-2.0/
'''
EPL1 = '''All rights reserved. This program and the accompanying materials
are made available under the terms of the Eclipse Public License v1.0
which accompanies this distribution, and is available at
http://www.eclipse.org/legal/epl-v10.html
'''
BODY = '''                                 Apache License
                           Version 2.0, January 2004
                        http://www.apache.org/licenses/

   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION

   1. Definitions.
'''
TITLES = '''                    GNU GENERAL PUBLIC LICENSE
                       Version 3, 29 June 2007

 The GNU General Public License is a free, copyleft license for
software and other kinds of works.

                   GNU LESSER GENERAL PUBLIC LICENSE
                       Version 3, 29 June 2007

                    GNU AFFERO GENERAL PUBLIC LICENSE
                       Version 3, 19 November 2007

                    GNU GENERAL PUBLIC LICENSE
                       Version 2, June 1991
'''
TEXTS = {
    "BSD-3 with its disclaimer": (BSD3 + DISCLAIMER, ["BSDRedist", "BSDSource", "BSDBinary", "BSDEndorse", *DISCLAIMED], ["BSD-3-Clause"]),
    "BSD-2 with its disclaimer": (BSD + DISCLAIMER, ["BSDRedist", "BSDSource", "BSDBinary", *DISCLAIMED], ["BSD-2-Clause"]),
    "AGPL": (AGPL, ["GPLFree", "AGPLLater", "GPLEither3", "GPLHope", "GPLMerchant", "AGPLSee"], ["AGPL-3.0-or-later"]),
    "LGPL": (LGPL, LGPL_IDS, ["LGPL-2.1-or-later"]),
    "LGPL without a comma": (LGPL.replace("software:", "software;").replace("Foundation,", "Foundation;"), LGPL_IDS, ["LGPL-2.1-or-later"]),
    "EPL-2": (EPL2, ["EPL2"], ["EPL-2.0"]),
    "EPL-1": (EPL1, ["AllRights", "EPL1"], ["LicenseRef-AllRightsReserved", "EPL-1.0"]),
    "Apache body": (BODY, ["ApacheTitle", "ApacheTerms"], ["Apache-2.0"]),
    "titles": (TITLES, ["GPL3Title", "GPL3Preamble", "LGPL3Title", "AGPL3Title", "GPL2Title"], ["GPL-3.0-only", "LGPL-3.0-only", "AGPL-3.0-only", "GPL-2.0-only"]),
    "MIT": (MIT, ["MITPerm", "MITNotice", "MITNoWarranty"], ["MIT"]),
    "Apache": (APACHE, ["ApacheLic2The", "ApacheUse", "ApacheCopyAt", "ApacheDist", "ApacheSee"], ["Apache-2.0"]),
    "BSD-2": (BSD, ["BSDRedist", "BSDSource", "BSDBinary"], ["BSD-2-Clause"]),
    "BSD-3": (BSD3, ["BSDRedist", "BSDSource", "BSDBinary", "BSDEndorse"], ["BSD-3-Clause"]),
    "GPL-3 with a comma": (GPL, [x or "GPLEither3" for x in GPL_IDS], ["GPL-3.0-or-later"]),
    "GPL-2": (GPL2, [x or "GPLEither2" for x in GPL_IDS], ["GPL-2.0-or-later"]),
    "GPL-3": (GPL3, [x or "GPLEither3" for x in GPL_IDS], ["GPL-3.0-or-later"]),
}


WRAPPED = {
    "ISC": (ISC, ["ISCPerm"], ["ISC"]),
    "MPL": (MPL, ["MPL2Subject"], ["MPL-2.0"]),
    "BSD": (BSD.replace("above copyright", "above\n   copyright"), *TEXTS["BSD-2"][1:]),
    "Apache": (APACHE.replace("License.\nYou", "License. You").replace("you may not", "you may\nnot").replace("; ", ";\n"), *TEXTS["Apache"][1:]),
    "no ends": ("All rights reserved\nReleased under the MIT License\nSee the\nLicensed under CC BY 4.0\n" + "copyright\n" * 600 + "All rights reserved",
                ["AllRights", "MITReleased", "CCBY", "AllRights"], ["LicenseRef-AllRightsReserved", "MIT", "CC-BY-4.0", "LicenseRef-AllRightsReserved"]),
    "signs": ("Copyright.\nAll rights\x02\nreserved", ["AllRights"], ["LicenseRef-AllRightsReserved"]),
}


def scanned(spark, texts, **params):
    df = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    return {r.id: (r.sentence_ids, r.licences) for r in licenses.scan(df, **params).collect()}


@pytest.mark.parametrize("sign", ["", "# ", "// ", " * ", "-- "])
def test_public_texts(spark, sign):
    got = scanned(spark, {n: "".join(sign + x for x in t.splitlines(True)) for n, (t, _, _) in TEXTS.items()})
    assert got == {n: (ids, found) for n, (_, ids, found) in TEXTS.items()}


def test_wrapped_lines_that_begin_like_a_sentence(spark):
    assert scanned(spark, {n: t for n, (t, _, _) in WRAPPED.items()}) == {n: (ids, found) for n, (_, ids, found) in WRAPPED.items()}


def test_every_sentence_wrapped_at_every_word(spark):
    texts, want = {}, {}
    for name, s in licenses.SENTENCES.items():
        w = s.split(" ")
        for cut in range(1, len(w) + 1):  # the last one has a word a line
            wrapped = " ".join(w[:cut]) + "\n" + " ".join(w[cut:]) if cut < len(w) else "\n".join(w)
            texts[f"{name} {cut}"], want[f"{name} {cut}"] = "Copyright.\n" + wrapped + ".", [name]
    assert {n: ids for n, (ids, _) in scanned(spark, texts).items()} == want


def test_address_behind_its_sentence(spark):
    got = scanned(spark, {w: APACHE.replace("at\n\n    http", f"at\n    {w}") for w in ("http", "https")})
    assert got == {w: TEXTS["Apache"][1:] for w in ("http", "https")}


def test_known_sentences_in_any_spelling(spark):
    known = {"Own": 'Use of "Things" (all), as is.'}
    got = scanned(spark, {"a": 'The software licensed.\nUse of "Things" (all), as is.'}, known=known, rules=[("Own-1", ["Own"])])
    assert got == {"a": (["Own"], ["Own-1"])}


def test_no_text_is_passed_over_unread(spark):
    reserved = {"wrapped": "All Rights\nReserved.", "wide": "All rights  reserved", "comment": "# all rights\n# reserved", "signs": "(All) \"rights\" *reserved*"}
    assert scanned(spark, reserved) == dict.fromkeys(reserved, (["AllRights"], ["LicenseRef-AllRightsReserved"]))
    own = {"A": "take it or leave it", "B": "for love, not money"}
    texts = {"a": "Take it\nor leave it!", "b": "For love, not \"money\".", "c": "nothing"}
    assert scanned(spark, texts, known=own, rules=[("Own-A", ["A"])]) == {"a": (["A"], ["Own-A"]), "b": (["B"], []), "c": ([], [])}
    assert licenses.hint(["take it", "+"]) == licenses.hint([]) == ""


def test_known_sentences_are_in_normal_form():
    assert all(licenses._plain(s) == s.rstrip(" .,;:/-") for s in licenses.SENTENCES.values())


def test_control_signs_cut_no_sentence(spark):
    texts = {sign: MIT.replace("free of charge", f"free{sign}of charge") for sign in "\x01\x02\x03 "}
    got = scanned(spark, texts)
    assert len({str(v) for v in got.values()}) == 1 and got[" "][1]
