"""Passages of license texts as they are written, with the label that each has to get."""

from __future__ import annotations

from rollbook.llm.license_scan import GATE, license_scan, signature_rules

PASSAGES = [
    ("mit", 'The above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.'),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd", "1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer."),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "All advertising materials mentioning features or use of this software must display the following acknowledgement:"),
    ("apache", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("apache", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,'),
    ("gpl", "This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl-3.0", "either version 3 of the License, or (at your option) any later version."),
    ("gpl-2.0", "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301, USA."),
    ("lgpl", "You should have received a copy of the GNU Lesser General Public License along with this library"),
    ("agpl", "You should have received a copy of the GNU Affero General Public License along with this program."),
    ("gfdl", "with no Invariant Sections, no Front-Cover Texts, and no Back-Cover Texts."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("mpl-2.0", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("zlib", "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software."),
    ("bsl", "Distributed under the Boost Software License, Version 1.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("ofl", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "Text is available under the Creative Commons Attribution-ShareAlike License"),
    ("cc-by-nc", "https://creativecommons.org/licenses/by-nc/4.0/"),
    ("openssl", "This product includes software developed by the OpenSSL Project for use in the OpenSSL Toolkit."),
    ("json", "The Software shall be used for Good, not Evil."),
    ("public-domain", "This is a work of the United States Government and is not subject to copyright protection in the United States."),
    ("proprietary", "No part of this publication may be reproduced, stored in a retrieval system, or transmitted"),
    ("artistic", "The intent of this document is to state the conditions under which a Package may be copied"),
    ("ogl", "Contains public sector information licensed under the Open Government Licence v3.0."),
]
OTHERS = ["The product includes a cable. Use of the site is free.", "He was granted a license to drive.", "Version 3 of the story, or any later one.", "A beer after the walk, and we meet some day."]


def test_passages(spark):
    rows = [(k, f"Some words before. {text} And some after.") for k, (_, text) in enumerate(PASSAGES)] + [(1000 + k, t) for k, t in enumerate(OTHERS)]
    got = {r["doc_id"]: r for r in license_scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    missed = [(label, got[k]["labels"]) for k, (label, _) in enumerate(PASSAGES) if label not in got[k]["labels"].split(",") or got[k]["score"] != 1.0]
    assert missed == []
    assert [got[1000 + k]["labels"] for k in range(len(OTHERS))] == [""] * len(OTHERS)


def test_every_rule_is_gated():
    """A text that a rule matches has the rule's keyword, and a text with that keyword, or the match, passes the gate."""
    rules = signature_rules()
    assert len(rules) > 350 and len({r.name for r in rules}) > 300
    assert [r.name for r in rules if "/text" in r.name and (r.keyword not in r.pattern or not any(g in r.keyword for g in GATE))] == []
