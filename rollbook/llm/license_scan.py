"""License scan by ordered signature rules.

Texts are normalised to ASCII-lower-case words with one blank between them. A cheap keyword test gates the
rules: of a text without any keyword nothing else is computed, and of the others only the rules whose own
keyword occurs. A rule's regex gives intervals. Detections are put in order of start, longest first; one
that lies inside another of the same or a higher priority is suppressed. All of it happens within the
row, so nothing is shuffled, and a text's cost grows with its length.

Cases: a null text is empty and has no words; a text without detections has empty label strings, null
places and score 0; of two equal intervals with equal priority the label that sorts first stays; rows are
judged one by one, so repeated rows repeat; an empty table gives an empty result; other columns pass, except those named like a result.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base phrases and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Name of a license in words (a regex), its keyword, label. A name comes with a version or without.
NAMES = (
    (r"apache(?: software)? licen[cs]e", "apache", "apache"),
    (r"mit licen[cs]e", "mit", "mit"),
    (r"x11 licen[cs]e", "x11", "x11"),
    (r"isc licen[cs]e", "isc", "isc"),
    (r"zlib(?: libpng)? licen[cs]e", "zlib", "zlib"),
    (r"boost software licen[cs]e", "boost", "bsl"),
    (r"(?:new |modified |revised |simplified )?bsd(?: [0-4] clause)? licen[cs]e", "bsd", "bsd"),
    (r"(?:gnu )?general public licen[cs]e", "general public", "gpl"),
    (r"(?:gnu )?(?:lesser|library) general public licen[cs]e", "general public", "lgpl"),
    (r"(?:gnu )?affero general public licen[cs]e", "affero", "agpl"),
    (r"(?:gnu )?free documentation licen[cs]e", "documentation", "gfdl"),
    (r"mozilla public licen[cs]e", "mozilla", "mpl"),
    (r"eclipse public licen[cs]e", "eclipse", "epl"),
    (r"common public licen[cs]e", "common public", "cpl"),
    (r"common development and distribution licen[cs]e", "common development", "cddl"),
    (r"european union public licen[cs]e", "european union", "eupl"),
    (r"artistic licen[cs]e", "artistic", "artistic"),
    (r"academic free licen[cs]e", "academic free", "afl"),
    (r"open software licen[cs]e", "open software", "osl"),
    (r"microsoft public licen[cs]e", "microsoft", "ms-pl"),
    (r"microsoft reciprocal licen[cs]e", "microsoft", "ms-rl"),
    (r"python(?: software foundation)? licen[cs]e", "python", "psf"),
    (r"ruby licen[cs]e", "ruby", "ruby"),
    (r"php licen[cs]e", "php", "php"),
    (r"openssl licen[cs]e", "openssl", "openssl"),
    (r"sil open font licen[cs]e", "open font", "ofl"),
    (r"open database licen[cs]e", "open database", "odbl"),
    (r"open data commons attribution licen[cs]e", "data commons", "odc-by"),
    (r"creative commons attribution(?: licen[cs]e)?", "creative commons", "cc-by"),
    (r"creative commons attribution share ?alike(?: licen[cs]e)?", "creative commons", "cc-by-sa"),
    (r"creative commons attribution non ?commercial(?: licen[cs]e)?", "creative commons", "cc-by-nc"),
    (r"creative commons attribution no ?deriv(?:ative)?s(?: licen[cs]e)?", "creative commons", "cc-by-nd"),
    (r"creative commons zero(?: licen[cs]e)?", "creative commons", "cc0"),
    (r"cc by", "cc by", "cc-by"),
    (r"cc by sa", "cc by", "cc-by-sa"),
    (r"cc by nc", "cc by", "cc-by-nc"),
    (r"cc by nd", "cc by", "cc-by-nd"),
    (r"cc by nc sa", "cc by", "cc-by-nc-sa"),
    (r"cc by nc nd", "cc by", "cc-by-nc-nd"),
    (r"(?:cc0|cc 0)", "cc", "cc0"),
    (r"do what the fuck you want to public licen[cs]e", "want to public", "wtfpl"),
    (r"unlicen[cs]e", "unlicen", "unlicense"),
)
#: What may stand around a name, and the priority of the rule. {v} is a version.
FRAMES = (
    (r"spdx licen[cs]e identifier {n}(?:{v})?", 4),
    (r"(?:dual )?licen[cs]ed under(?: the)?(?: terms of)?(?: the)? {n}(?:{v})?", 3),
    (r"(?:released|distributed|published|available|provided|shared) under(?: the)?(?: terms of)?(?: the)? {n}(?:{v})?", 3),
    (r"(?:governed by|subject to|covered by)(?: the)?(?: terms of)?(?: the)? {n}(?:{v})?", 3),
    (r"{n}{v}", 2),
    (r"{n}", 1),
)
VERSION = r"(?: version| v)? v?[0-9]+(?: [0-9]+)*(?: or(?: at your option)?(?: any)? later)?"
#: Rules without a license name: regex, keyword, label, priority.
NOTICES = (
    (r"all rights reserved", "reserved", "reserved", 2),
    (r"some rights reserved", "reserved", "some-reserved", 2),
    (r"no rights reserved", "reserved", "public-domain", 2),
    (r"copyright(?: c)?(?: [0-9]{4})+", "copyright", "copyright", 1),
    (r"(?:dedicated to|placed in|in) the public domain", "public domain", "public-domain", 3),
    (r"redistribution and use in source and binary forms", "redistribution", "bsd", 3),
    (r"provided as is without (?:any )?warranty of any kind", "warranty", "no-warranty", 1),
    (r"(?:proprietary and )?confidential do not distribute", "confidential", "proprietary", 2),
    (r"not for commercial use", "commercial", "non-commercial", 2),
    (r"for (?:personal and )?non ?commercial (?:use|purposes) only", "commercial", "non-commercial", 2),
    (r"unauthori[sz]ed (?:copying|reproduction|use) (?:of this \w+ )?is (?:strictly )?prohibited", "unauthori", "proprietary", 2),
)
#: Signatures from the notices and bodies of licenses, in words: label, then a regex each with its keyword. Priority 4.
SIGNATURES = {
    "mit": (
        (r"permission is hereby granted free of charge to any person obtaining a copy", "hereby granted"),
        (r"to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell", "without restriction"),
        (r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "permission notice"),
        (r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability", "as is without warranty"),
        (r"in no event shall the authors or copyright holders be liable for any claim damages or other liability", "copyright holders be liable"),
    ),
    "x11": (
        (r"except as contained in this notice the name of .{1,80}? shall not be used in advertising or otherwise to promote the sale", "contained in this notice"),
    ),
    "mit-0": (
        (r"to whom the software is furnished to do so the software is provided as is without warranty", "furnished to do so"),
    ),
    "isc": (
        (r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice", "hereby granted"),
        (r"the software is provided as is and the author disclaims all warranties with regard to this software", "disclaims all warranties"),
        (r"in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use", "author be liable"),
    ),
    "0bsd": (
        (r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided", "hereby granted"),
    ),
    "bsd": (
        (r"redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use"),
        (r"redistributions of source code must retain the above copyright notice this list of conditions", "redistributions of source"),
        (r"redistributions in binary form must reproduce the above copyright notice this list of conditions", "redistributions in binary"),
        (r"this software is provided by the (?:copyright holders? and contributors|regents and contributors|author) as is and any express or implied warranties", "as is and any express"),
        (r"however caused and on any theory of liability whether in contract strict liability or tort", "theory of liability"),
    ),
    "bsd-3-clause": (
        (r"neither the name of .{1,80}? nor the names of its contributors may be used to endorse or promote products", "neither the name"),
        (r"the names? of .{1,40}? may not be used to endorse or promote products derived from this software without (?:specific )?prior written permission", "endorse or promote"),
    ),
    "bsd-4-clause": (
        (r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment", "advertising materials"),
        (r"this product includes software developed by the university of california", "product includes software"),
    ),
    "bsd-patent": (
        (r"subject to the terms and conditions of this license each copyright holder and contributor hereby grants to those receiving rights", "those receiving rights"),
    ),
    "apache": (
        (r"licensed under the apache license version 2 0 the license you may not use this file except in compliance", "apache license"),
        (r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "required by applicable law"),
        (r"see the license for the specific language governing permissions and limitations under the license", "specific language governing"),
        (r"licensed to the apache software foundation asf under one or more contributor license agreements", "apache software foundation"),
        (r"a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce prepare derivative works", "irrevocable copyright license"),
        (r"you must cause any modified files to carry prominent notices stating that you changed the files", "prominent notices"),
        (r"this product includes software developed by the apache (?:software foundation|group)", "product includes software"),
    ),
    "gpl": (
        (r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "general public license"),
        (r"you should have received a copy of the gnu general public license along with", "general public license"),
        (r"see the gnu general public license for more details", "general public license"),
        (r"the licenses for most software are designed to take away your freedom to share and change it", "freedom to share"),
        (r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed", "verbatim copies"),
        (r"you may convey verbatim copies of the program s source code as you receive it in any medium", "verbatim copies"),
        (r"a work based on the program means either the program or any derivative work under copyright law", "work based on the program"),
        (r"the gnu general public license is a free copyleft license for software", "copyleft license"),
        (r"this program comes with absolutely no warranty", "absolutely no warranty"),
    ),
    "gpl-2.0": (
        (r"either version 2 of the license or at your option any later version", "version 2 of the license"),
        (r"gnu general public license version 2 june 1991", "version 2 june"),
        (r"51 franklin street fifth floor boston ma 02110 1301", "franklin street"),
        (r"59 temple place suite 330 boston ma 02111 1307", "temple place"),
    ),
    "gpl-3.0": (
        (r"either version 3 of the license or at your option any later version", "version 3 of the license"),
        (r"gnu general public license version 3 29 june 2007", "29 june 2007"),
    ),
    "gpl-classpath": (
        (r"as a special exception the copyright holders of this library give you permission to link this library with independent modules", "special exception"),
        (r"linking this library statically or dynamically with other modules is making a combined work", "combined work"),
    ),
    "lgpl": (
        (r"this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license", "general public license"),
        (r"you should have received a copy of the gnu (?:lesser|library) general public license", "general public license"),
        (r"this license applies to any software library or other program which contains a notice placed by the copyright holder", "software library"),
        (r"a program that contains no derivative of any portion of the library but is designed to work with the library", "derivative of any portion"),
        (r"this version of the gnu lesser general public license incorporates the terms and conditions of version 3", "lesser general public"),
    ),
    "agpl": (
        (r"you should have received a copy of the gnu affero general public license", "affero"),
        (r"if you modify the program your modified version must prominently offer all users interacting with it remotely through a computer network", "interacting with it remotely"),
        (r"gnu affero general public license version 3 19 november 2007", "affero"),
    ),
    "gfdl": (
        (r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", "free documentation license"),
        (r"with no invariant sections no front cover texts and no back cover texts", "invariant sections"),
        (r"the purpose of this license is to make a manual textbook or other functional and useful document free", "manual textbook"),
    ),
    "mpl": (
        (r"the contents of this file are subject to the mozilla public license", "mozilla public license"),
        (r"software distributed under the license is distributed on an as is basis without warranty of any kind either express or implied see the license", "as is basis without warranty"),
    ),
    "mpl-2.0": (
        (r"this source code form is subject to the terms of the mozilla public license v 2 0", "source code form"),
        (r"if a copy of the mpl was not distributed with this file you can obtain one at", "mpl was not distributed"),
        (r"incompatible with secondary licenses as defined by the mozilla public license", "secondary licenses"),
    ),
    "epl": (
        (r"the accompanying program is provided under the terms of this eclipse public license", "eclipse public license"),
        (r"this program and the accompanying materials are made available under the terms of the eclipse public license", "eclipse public license"),
        (r"this source code may also be made available under the following secondary licenses", "secondary licenses"),
    ),
    "cpl": (
        (r"the accompanying program is provided under the terms of this common public license", "common public license"),
    ),
    "cddl": (
        (r"the contents of this file are subject to the terms of the common development and distribution license", "common development"),
        (r"you can obtain a copy of the license at .{1,80}? or http www opensolaris org os licensing", "opensolaris"),
        (r"when distributing covered code include this cddl header in each file", "cddl header"),
    ),
    "eupl": (
        (r"licensed under the eupl", "eupl"),
        (r"this european union public licence the eupl applies to the work", "european union public"),
    ),
    "artistic": (
        (r"the intent of this document is to state the conditions under which a package may be copied", "package may be copied"),
        (r"copyright holder maintains some semblance of artistic control over the development", "semblance of artistic"),
        (r"this is free software you can redistribute it and or modify it under the same terms as (?:the )?perl", "same terms as"),
        (r"this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed", "given free software package"),
    ),
    "zlib": (
        (r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", "authors be held liable"),
        (r"the origin of this software must not be misrepresented you must not claim that you wrote the original software", "must not be misrepresented"),
        (r"altered source versions must be plainly marked as such and must not be misrepresented", "plainly marked"),
    ),
    "bsl": (
        (r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "person or organization"),
        (r"distributed under the boost software license version 1 0", "boost software license"),
    ),
    "unlicense": (
        (r"this is free and unencumbered software released into the public domain", "unencumbered software"),
        (r"anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary", "compile sell or distribute"),
        (r"in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest", "jurisdictions that recognize"),
    ),
    "wtfpl": (
        (r"you just do what the fuck you want to", "you want to"),
    ),
    "psf": (
        (r"this license agreement is between the python software foundation psf", "python software foundation"),
        (r"psf hereby grants licensee a nonexclusive royalty free world wide license", "psf hereby grants"),
        (r"psf is making python available to licensee on an as is basis", "psf is making"),
    ),
    "php": (
        (r"this product includes php software freely available from", "php software"),
        (r"products derived from this software may not be called php", "may not be called"),
    ),
    "openssl": (
        (r"this product includes software developed by the openssl project for use in the openssl toolkit", "openssl project"),
        (r"this product includes cryptographic software written by eric young", "cryptographic software"),
    ),
    "ofl": (
        (r"this font software is licensed under the sil open font license", "font software"),
        (r"the fonts including any derivative works can be bundled embedded redistributed and or sold with any software", "bundled embedded"),
        (r"no modified version of the font software may use the reserved font name", "reserved font name"),
    ),
    "cc0": (
        (r"the person who associated a work with this deed has dedicated the work to the public domain", "public domain"),
        (r"to the extent possible under law .{1,80}? has waived all copyright and related or neighboring rights", "extent possible under law"),
        (r"affirmer hereby overtly fully permanently irrevocably and unconditionally waives", "affirmer hereby"),
    ),
    "cc-by": (
        (r"this work is licensed under (?:a |the )?creative commons attribution(?! share| non| no )", "creative commons attribution"),
        (r"you must give appropriate credit provide a link to the license and indicate if changes were made", "appropriate credit"),
        (r"creativecommons org licenses by [0-9]", "creativecommons org licenses"),
    ),
    "cc-by-sa": (
        (r"this work is licensed under (?:a |the )?creative commons attribution share ?alike", "creative commons attribution"),
        (r"if you remix transform or build upon the material you must distribute your contributions under the same license", "remix transform"),
        (r"creativecommons org licenses by sa [0-9]", "creativecommons org licenses"),
        (r"text is available under the creative commons attribution share ?alike license", "text is available"),
    ),
    "cc-by-nc": (
        (r"this work is licensed under (?:a |the )?creative commons attribution non ?commercial", "creative commons attribution"),
        (r"you may not use the material for commercial purposes", "commercial purposes"),
        (r"creativecommons org licenses by nc [0-9]", "creativecommons org licenses"),
    ),
    "cc-by-nd": (
        (r"if you remix transform or build upon the material you may not distribute the modified material", "remix transform"),
        (r"creativecommons org licenses by nd [0-9]", "creativecommons org licenses"),
    ),
    "odbl": (
        (r"this data is made available under the open database license", "open database license"),
        (r"any rights in individual contents of the database are licensed under the database contents license", "database contents license"),
        (r"contains information from .{1,60}? which is made available here under the open database license", "open database license"),
    ),
    "pddl": (
        (r"made available under the public domain dedication and license", "public domain dedication"),
    ),
    "ogl": (
        (r"contains public sector information licensed under the open government licen[cs]e", "open government"),
        (r"you are free to copy publish distribute and transmit the information", "transmit the information"),
    ),
    "ms-pl": (
        (r"this license governs use of the accompanying software if you use the software you accept this license", "license governs use"),
    ),
    "busl": (
        (r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work", "non production use"),
        (r"effective on the change date or the fourth anniversary of the first publicly available distribution", "change date"),
    ),
    "sspl": (
        (r"if you make the functionality of the program or a modified version available to third parties as a service", "third parties as a service"),
    ),
    "elastic": (
        (r"you may not provide the software to third parties as a hosted or managed service", "hosted or managed"),
    ),
    "json": (
        (r"the software shall be used for good not evil", "good not evil"),
    ),
    "beerware": (
        (r"if we meet some day and you think this stuff is worth it you can buy me a beer", "buy me a beer"),
    ),
    "public-domain": (
        (r"this (?:file|work|code|software|text) is in the public domain", "public domain"),
        (r"has been released into the public domain by (?:its|the) (?:author|copyright holder)", "public domain"),
        (r"this is a work of the united states government and is not subject to copyright protection", "united states government"),
        (r"not protected by copyright (?:law )?in the united states", "protected by copyright"),
    ),
    "proprietary": (
        (r"this software is the confidential and proprietary information of", "confidential and proprietary"),
        (r"no part of this (?:publication|book|document|work) may be reproduced (?:stored in a retrieval system )?(?:or )?transmitted", "may be reproduced"),
        (r"no part of this (?:publication|book|document|work) may be reproduced in any form", "may be reproduced"),
        (r"reproduction in whole or in part without (?:written )?permission is prohibited", "whole or in part"),
        (r"may not be published broadcast rewritten or redistributed", "broadcast rewritten"),
        (r"use of this (?:site|website|service) constitutes acceptance of our (?:user agreement|terms)", "constitutes acceptance"),
        (r"licensed not sold", "licensed not sold"),
        (r"end user licen[cs]e agreement", "end user licen"),
    ),
}
#: One of these occurs in every text that a rule can match (compared in lower case): common words, and the keywords without one.
_COMMON = ("licen", "reserved", "cc by", "cc0", "cc 0", "creative commons", "copyright", "public domain", "hereby granted", "redistribution", "warranty", "confidential", "commercial use", "commercial purposes", "unauthori")
GATE = _COMMON + tuple(dict.fromkeys(k for some in SIGNATURES.values() for _, k in some if not any(w in k for w in _COMMON)))
RESULT = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_detections")
#: Matches of a rule whose lengths are summed at a time.
RUN = 64
WEIGHT = {1: 0.4, 2: 0.6, 3: 0.8, 4: 1.0}


@dataclass(frozen=True)
class Rule:
    name: str
    pattern: str
    keyword: str
    label: str
    priority: int


def signature_rules() -> list[Rule]:
    """The rules in order: every frame around every name, then the signatures of texts, then the notices."""
    rules = []
    for name, keyword, label in NAMES:
        for k, (frame, priority) in enumerate(FRAMES):
            rules.append(Rule(f"{label}/{k}", frame.replace("{n}", name).replace("{v}", VERSION), keyword, label, priority))
    rules += [Rule(f"{label}/text{k}", pattern, keyword, label, 4) for label, some in SIGNATURES.items() for k, (pattern, keyword) in enumerate(some)]
    rules += [Rule(f"notice/{k}", *x) for k, x in enumerate(NOTICES)]
    return rules


def _table(rules: list[Rule]) -> Column:
    rows = [{"p": f" {r.pattern}(?= )", "k": r.keyword, "l": r.label, "o": r.priority} for r in rules]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<p: string, k: string, l: string, o: int>>")


def license_scan(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """The columns of `docs` and n_words, n_base, first_word, last_word, base_labels, labels, score, n_detections."""
    table = _table(signature_rules() if rules is None else rules)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    own = [c for c in docs.columns if c not in RESULT]
    # kept apart, so that no name can clash
    step = docs.select(F.struct(*(F.col(f"`{c}`") for c in own)).alias("_own"), F.expr("coalesce(text, '')").alias("_raw"))
    # upper-case letters are word characters, as they'd be in lower case
    step = step.withColumn(
        "_norm", F.expr(r"concat(' ', trim(regexp_replace(_raw, '[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+', ' ')), ' ')")
    )
    step = step.withColumn("_low", F.lower("_norm"))
    gate = None
    for word in GATE:
        gate = F.contains("_low", F.lit(word)) if gate is None else gate | F.contains("_low", F.lit(word))
    step = step.select(
        "_own",
        F.expr("CAST(if(_norm = '  ', 0, length(_norm) - length(replace(_norm, ' ', '')) - 1) AS BIGINT)").alias("n_words"),
        F.when(gate, F.translate("_norm", upper, lower)).otherwise(F.lit("  ")).alias("_t"),
    )
    step = step.withColumn("_wide", F.expr("replace(_t, ' ', '  ')"))
    places, first, last = [], [], []
    for phrase, _ in BASE:
        wide, text = f" {phrase.replace(' ', '  ')} ", f" {phrase} "
        places.append(f"((length(_wide) - length(replace(_wide, '{wide}', ''))) div {len(wide)})")
        first.append(f"nullif(instr(_t, '{text}'), 0)")
        last.append(f"(length(_t) - {len(text)} + 2 - nullif(instr(_back, '{text[::-1]}'), 0))")
    step = step.withColumn("_back", F.reverse("_t"))
    step = step.withColumns(
        {
            "_places": F.expr(f"array({', '.join(places)})"),
            "_first": F.expr(f"least({', '.join(first)})"),
            "_last": F.expr(f"greatest({', '.join(last)})"),
            "_rules": F.when(F.expr("_t != '  '"), F.filter(table, lambda r: F.contains(F.col("_t"), r["k"]))).otherwise(F.filter(table, lambda r: F.lit(False))),
        }
    )
    # the pieces between a rule's matches give its places: sums over whole runs of matches, then within a run
    step = step.withColumn(
        "_found",
        F.expr(
            "filter(transform(_rules, r -> struct(r.l AS l, r.o AS o, regexp_extract_all(_t, r.p, 0) AS m, split(_t, r.p, -1) AS s)), x -> size(x.m) > 0)"
        ),
    )
    step = step.withColumn("_found", F.expr("transform(_found, x -> struct(x.l AS l, x.o AS o, transform(x.m, m -> length(m)) AS m, transform(x.m, (m, j) -> length(m) + length(get(x.s, j))) AS d))"))
    runs = f"transform(sequence(0, (size(x.d) - 1) div {RUN}), c -> aggregate(slice(x.d, c * {RUN} + 1, {RUN}), 0, (n, y) -> n + y))"
    step = step.withColumn("_found", F.expr(f"transform(_found, x -> struct(x.l AS l, x.o AS o, x.m AS m, x.d AS d, {runs} AS c))"))
    step = step.withColumn("_found", F.expr("transform(_found, x -> struct(x.l AS l, x.o AS o, x.m AS m, x.d AS d, transform(x.c, (n, k) -> aggregate(slice(x.c, 1, k), 0, (n, y) -> n + y)) AS c))"))
    end = f"get(x.c, CAST(j div {RUN} AS INT)) + aggregate(slice(x.d, CAST(j div {RUN} AS INT) * {RUN} + 1, j % {RUN} + 1), 0, (n, y) -> n + y)"
    step = step.withColumn("_ends", F.expr(f"transform(_found, x -> transform(x.m, (m, j) -> {end}))"))
    step = step.withColumn(
        "_hits",
        F.expr(
            "sort_array(flatten(transform(_found, (x, k) -> transform(x.m, (m, j) -> named_struct("
            "'start', get(get(_ends, k), j) - m, 'back', -get(get(_ends, k), j), 'under', -x.o, 'label', x.l)))))"
        ),
    )
    levels = sorted(WEIGHT)
    inside = " OR ".join(f"(-h.under <= {p} AND a.e{p} >= -h.back)" for p in levels)
    ends = ", ".join(f"'e{p}', if(h.under = {-p}, greatest(a.e{p}, -h.back), a.e{p})" for p in levels)
    zero = ", ".join(f"'e{p}', -1" for p in levels)
    step = step.withColumn(
        "_kept",
        F.expr(
            f"aggregate(_hits, named_struct({zero}, 'best', 0, 'n', 0L, 'labels', CAST(array() AS ARRAY<STRING>)), (a, h) -> named_struct({ends}, "
            f"'best', if({inside}, a.best, greatest(a.best, -h.under)), 'n', if({inside}, a.n, a.n + 1), "
            f"'labels', if({inside} OR array_contains(a.labels, h.label), a.labels, array_append(a.labels, h.label))))"
        ),
    )
    found = ", ".join(f"if(_places[{k}] > 0, '{label}', NULL)" for k, (_, label) in enumerate(BASE))
    step = step.withColumn("_base", F.expr(f"array_compact(array({found}))"))
    weight = "CASE _kept.best " + " ".join(f"WHEN {p} THEN {w}D" for p, w in WEIGHT.items()) + " ELSE 0D END"
    before = "CAST(length(substring(_t, 1, {0})) - length(replace(substring(_t, 1, {0}), ' ', '')) - 1 AS BIGINT)"
    return step.select(
        "_own.*",
        "n_words",
        F.expr("CAST(" + " + ".join(f"_places[{k}]" for k in range(len(BASE))) + " AS BIGINT)").alias("n_base"),
        F.expr(before.format("_first")).alias("first_word"),
        F.expr(before.format("_last")).alias("last_word"),
        F.expr("array_join(array_sort(_base), ',')").alias("base_labels"),
        F.expr("array_join(array_sort(array_union(_base, _kept.labels)), ',')").alias("labels"),
        F.expr(f"greatest({weight}, if(size(_base) > 0, 0.5D, 0D))").alias("score"),
        F.expr("_kept.n").alias("n_detections"),
    )
