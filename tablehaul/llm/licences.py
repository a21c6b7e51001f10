"""Licence scan: a trained paragraph classifier, calibrated, and confirmed against templates.

Texts are split into paragraphs at blank lines, whose lines are joined, and those into segments of a fixed number of overlapping
words, so a licence statement up to the overlap lies whole in one segment wherever it stands or wraps. A
multinomial logistic regression over hashed word n-grams names a family, ``unknown`` (a licence of no family here, or one that is
denied), or ``none``. Its scores are divided by a temperature fitted on held-out rows; the least confidence for a
family is set there too, from rows that are of no family. A family is reported if it is confident and the segment holds enough of one
of the family's templates, the names, sentences and pieces of paragraphs below; licence-like segments that fail either, or that the
classifier calls so, are ``unknown``.

Rows of families are made from public licence names, sentences and whole paragraphs, alone and among ordinary sentences; rows of
``unknown`` from paragraphs of other licences and from denials. Held out are whole wordings, whole other licences and segments of
paragraphs, not rows of the same wording. Rows of class ``none`` are segments of
``sample_documents`` documents, those with the smallest hashes, and a few sentences that use the same
words otherwise. Everything else covers all texts. Only DataFrame, SQL and Spark ML functions are used.

NULL text counts as empty and has no paragraphs. A NULL id is kept, repeated rows get equal answers,
an empty table gives no rows (its classifier then knows only the sentences below). Other columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tablehaul.llm.texts import whole_text
from tablehaul.sources.files import staged

SEGMENT_WORDS = 48
OVERLAP_WORDS = 24
FEATURES = 1 << 15
SAMPLE_DOCUMENTS = 400
HELD_OUT = 4  # one row of so many is held out
TEMPERATURES = (0.5, 0.7, 1.0, 1.4, 2.0, 2.8)
MAX_FALSE_SHARE = 0.001
THRESHOLDS = tuple(i / 20 for i in range(2, 20))
MIN_CONTAINMENT = 0.6
CALIBRATION_BINS = 10
NONE, UNKNOWN = "none", "unknown"
# Words of a paragraph that make one template; so many lie whole in some segment.
TEMPLATE_WORDS = SEGMENT_WORDS - OVERLAP_WORDS

# Names that licence families go by.
NAMES = {
    "agpl": ("GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPLv3", "AGPL-3.0-or-later", "Affero GPL"),
    "apache": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 license", "Apache-2.0", "Apache Software License"),
    "bsd": ("BSD 3-Clause License", "BSD 2-Clause License", "New BSD License", "Simplified BSD License", "BSD-3-Clause", "BSD license"),
    "cc-by": ("Creative Commons Attribution 4.0 International License", "CC BY 4.0", "CC-BY-3.0", "Creative Commons Attribution License"),
    "cc-by-nc": (
        "Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 4.0", "CC-BY-NC-3.0", "CC BY-NC-SA 4.0",
        "CC BY-NC-ND 4.0",
    ),
    "cc-by-nd": ("Creative Commons Attribution-NoDerivatives 4.0 International License", "CC BY-ND 4.0", "CC-BY-ND-3.0"),
    "cc-by-sa": ("Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0", "CC-BY-SA-3.0"),
    "cc0": ("CC0 1.0 Universal", "CC0-1.0", "Creative Commons Zero", "CC0 public domain dedication"),
    "bsl": ("Boost Software License 1.0", "Boost Software License, Version 1.0", "BSL-1.0"),
    "epl": ("Eclipse Public License 2.0", "Eclipse Public License, version 1.0", "EPL-2.0"),
    "gpl": (
        "GNU General Public License, version 3", "GNU General Public License, version 2", "GNU General Public License", "GNU GPL v3",
        "GPLv2", "GPL-3.0-or-later", "GNU GPL",
    ),
    "isc": ("ISC License", "ISC licence", "ISC-style license"),
    "lgpl": ("GNU Lesser General Public License, version 3", "GNU Lesser General Public License", "GNU LGPL", "LGPL-2.1-or-later", "LGPLv3"),
    "mit": ("MIT License", "MIT licence", "Expat License", "MIT-style license"),
    "mpl": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL-2.0", "MPL 2.0"),
    "unlicense": ("Unlicense", "The Unlicense"),
    "zlib": ("zlib License", "zlib/libpng License", "zlib-style license"),
}

# Sentences that licence texts and notices are made of.
SENTENCES = {
    "apache": (
        "you may not use this file except in compliance with the License",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    ),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License",),
    "unlicense": ("This is free and unencumbered software released into the public domain",),
}

# Paragraphs of public licence texts and of the notices that they ask for.
PARAGRAPHS = {
    "agpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.",
        "You should have received a copy of the GNU Affero General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "\"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document.",
        "\"Licensor\" shall mean the copyright owner or entity authorized by the copyright owner that is granting the License.",
        "\"Legal Entity\" shall mean the union of the acting entity and all other entities that control, are controlled by, or are under common control with that entity.",
        "\"You\" (or \"Your\") shall mean an individual or Legal Entity exercising permissions granted by this License.",
        "\"Source\" form shall mean the preferred form for making modifications, including but not limited to software source code, documentation source, and configuration files.",
        "\"Object\" form shall mean any form resulting from mechanical transformation or translation of a Source form, including but not limited to compiled object code, generated documentation, and conversions to other media types.",
        "\"Contributor\" shall mean Licensor and any individual or Legal Entity on behalf of whom a Contribution has been received by Licensor and subsequently incorporated within the Work.",
        "Grant of Copyright License. Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    "bsl": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
        "The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.",
    ),
    "cc-by": (
        "This work is licensed under the Creative Commons Attribution 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/ or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA.",
        "Dieses Werk ist lizenziert unter einer Creative Commons Namensnennung 4.0 International Lizenz.",
    ),
    "cc-by-nc": ("Dieses Werk ist lizenziert unter einer Creative Commons Namensnennung - Nicht kommerziell 4.0 International Lizenz.",),
    "cc-by-sa": (
        "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-sa/4.0/.",
        "Dieses Werk ist lizenziert unter einer Creative Commons Namensnennung - Weitergabe unter gleichen Bedingungen 4.0 International Lizenz.",
    ),
    "cc0": (
        "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work.",
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
        "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
        "When we speak of free software, we are referring to freedom, not price. Our General Public Licenses are designed to make sure that you have the freedom to distribute copies of free software (and charge for them if you wish), that you receive source code or can get it if you want it, that you can change the software or use pieces of it in new free programs, and that you know you can do these things.",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.",
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
        "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.",
        "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
        "3. This notice may not be removed or altered from any source distribution.",
    ),
}

# Paragraphs of licences that are no family here; every fourth licence is held out whole.
OTHER_LICENCES = {
    "wtfpl": ("Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.",),
    "ofl": (
        "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of the Font Software, to use, study, copy, merge, embed, modify, redistribute, and sell modified and unmodified copies of the Font Software, subject to the following conditions:",
        "Neither the Font Software nor any of its individual components, in Original or Modified Versions, may be sold by itself.",
    ),
    "proprietary": (
        "This software is proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited.",
        "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher.",
        "The software is licensed, not sold. You may not reverse engineer, decompile or disassemble the software, or rent, lease or lend it.",
    ),
    "postgresql": (
        "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies.",
    ),
    "odbl": ("This database is made available under the Open Database License. Any rights in individual contents of the database are licensed under the Database Contents License.",),
    "artistic": (
        "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
        "You may Distribute your Modified Version as Source, either gratis or for a Distributor Fee, and with or without a Compiled form of the Modified Version, provided that you clearly document how it differs from the Standard Version.",
    ),
    "ms-pl": (
        "This license governs use of the accompanying software. If you use the software, you accept this license. If you do not accept the license, do not use the software.",
        "If you distribute any portion of the software, you must retain all copyright, patent, trademark, and attribution notices that are present in the software.",
    ),
    "ncsa": (
        "Neither the names of the development group, the institution, nor the names of its contributors may be used to endorse or promote products derived from this Software without specific prior written permission.",
    ),
    "eupl": ("Licensed under the EUPL, Version 1.2. You may not use this work except in compliance with the Licence.",),
    "named": (
        "Licensed under the terms of our house license.", "Released under a custom license, see LICENSE.", "Use is subject to the license agreement that came with the product.",
        "By installing the program you accept the terms of this end user license agreement.", "Distributed under the Acme Community License.",
    ),
}

DENIALS = (
    "This is not released under the {}, it is proprietary.", "Not licensed under {}.", "No longer available under the {}.",
    "Unlike earlier versions this one is not distributed under the {}.", "The code is not covered by the {}.",
    "We do not license this work under the {}.", "It was never released under the {}.", "Files here are not under {} but under our own terms.",
    "This software is not licensed under the {}, all rights are reserved.", "Nothing on this site is available under {}.",
    "You cannot use this project under the terms of the {} any more.", "The work is not published under {} by its authors.",
    "Content is no longer licensed under a {}.", "Never distributed under the {}", "Do not treat this as released under the {}.",
    "The program isn't available under {}.", "This isn't released under the {}.", "The files aren't licensed under the {}.",
    "Our code isn't under {}, ask us first.", "It isn't distributed under the terms of the {}.",
)

OPENINGS = (
    "Licensed under the {}.", "Released under the {}.", "This work is licensed under the {}.", "This software is released under the {}",
    "This project is distributed under the terms of the {}.", "Available under {}.", "License: {}", "SPDX-License-Identifier: {}",
    "The code is covered by the {}, see the file LICENSE for details.", "Content on this site is licensed under a {}.",
    "Copyright (c) 2019 the authors. Licensed under {}.", "{}", "Published under {} by its authors",
)

ORDINARY = (
    "He lost his driving licence on the way to the station.", "The license plate was covered by snow.", "A new version was released today.",
    "The minutes were distributed under the chairs.", "They worked under pressure, and the work was published in spring.",
    "General public opinion has changed.", "The public library opens at nine.", "Copyright is a field of law.", "Permission to land was given.",
    "The terms of the treaty are under review.", "An apache helicopter flew by.", "The foundation gives free meals.", "MIT is a university.",
    "The software is available in stores.", "Attribution of the painting is uncertain.", "Source of the river, version 2.0 of the map.",
    "You may not use this door.", "The above conditions are met by all.", "See the file for details.", "This site is about common birds.",
    "Content was created by the authors in 2019.", "A commercial break followed.", "Licensed drivers only.", "All rights and duties",
)


# segments

BLANK_LINE = r"\r?\n[ \t\x0B\f\r]*\n"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def segments(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SEGMENT_WORDS, overlap: int = OVERLAP_WORDS) -> DataFrame:
    """(doc_id, text_hash, paragraph, words): overlapping runs of words of every paragraph that has any."""
    whole = whole_text(text)
    lines = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(whole).alias("text_hash"), F.posexplode(F.split(whole, BLANK_LINE)).alias("paragraph", "line")
    )
    worded = lines.select("doc_id", "text_hash", "paragraph", words_of(F.col("line")).alias("all")).where(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - F.lit(overlap), F.lit(1)), F.lit(size - overlap))
    cut = worded.select("doc_id", "text_hash", "paragraph", "all", F.explode(starts).alias("at"))
    return cut.select("doc_id", "text_hash", "paragraph", F.slice("all", F.col("at"), F.lit(size)).alias("words"))


def with_features(rows: DataFrame, n_features: int = FEATURES) -> DataFrame:
    """Binary hashed one- and two-word features of ``words``."""
    pairs = NGram(n=2, inputCol="words", outputCol="pairs").transform(rows)
    grams = pairs.withColumn("grams", F.concat("words", "pairs"))
    return HashingTF(numFeatures=n_features, binary=True, inputCol="grams", outputCol="features").transform(grams).drop("grams")


# the classifier


@dataclass
class Classifier:
    model: LogisticRegressionModel
    families: list[str]
    temperature: float
    threshold: float
    n_features: int
    # Of held-out rows, classes weighing alike: families named that are right, and rows of a family that are named so. Then the rows of
    # other licences and denials that get no family, and the mean gap between confidence and share right.
    precision: float | None = None
    recall: float | None = None
    unknown_kept: float | None = None
    calibration_error: float | None = None


def _cut(paragraph: str, size: int, step: int) -> list[str]:
    words = paragraph.split()
    return [" ".join(words[i : i + size]) for i in range(0, max(len(words) - size + step, 1), step)]


def _pieces(paragraph: str) -> list[str]:
    """Pieces of equal size that cover a paragraph; the last one may overlap the one before."""
    words = paragraph.split()
    last = max(len(words) - TEMPLATE_WORDS, 0)
    return [" ".join(words[i : i + TEMPLATE_WORDS]) for i in (*range(0, last, TEMPLATE_WORDS), last)]


def _denied(opening: str, n: int) -> str:
    """A sentence that says the opposite."""
    if " is " in opening:
        return opening.replace(" is ", (" is not ", " is no longer ", " was never ")[n % 3], 1)
    return ("Not {}", "This is not {}", "Never {}")[n % 3].format(opening)


def labelled_rows(spark: SparkSession) -> DataFrame:
    """(family, words, held) made from the lists above; wordings, denials and other licences are held out whole."""
    rows = []

    def add(family: str, line: str, held: bool) -> None:
        n = len(rows)
        rows.append((family, line, held))
        rows.append((family, f"{ORDINARY[n % len(ORDINARY)]} {line} {ORDINARY[(n + 7) % len(ORDINARY)]}", held))

    for family, names in NAMES.items():
        for name in names:
            for n, opening in enumerate(OPENINGS):
                add(family, opening.format(name), n % HELD_OUT == HELD_OUT - 1)
        for name in names:
            for n, denial in enumerate(DENIALS):
                add(UNKNOWN, denial.format(name), n % HELD_OUT == HELD_OUT - 1)
            for n, opening in enumerate(OPENINGS):
                add(UNKNOWN, _denied(opening, n).format(name), n % HELD_OUT == HELD_OUT - 1)
    for family, sentences in SENTENCES.items():
        for sentence in sentences:
            add(family, sentence, False)
    for n, paragraphs in enumerate(OTHER_LICENCES.values()):
        for paragraph in paragraphs:
            for line in _cut(paragraph, SEGMENT_WORDS, OVERLAP_WORDS):
                add(UNKNOWN, line, n % HELD_OUT == HELD_OUT - 1)
    for family, paragraphs in PARAGRAPHS.items():
        for paragraph in paragraphs:
            for line in (*_cut(paragraph, SEGMENT_WORDS, OVERLAP_WORDS), *_cut(paragraph, TEMPLATE_WORDS, TEMPLATE_WORDS)):
                add(family, line, False)
        # cuts of the whole text that the rows above do not have
        for line in _cut(" ".join(paragraphs), SEGMENT_WORDS, SEGMENT_WORDS - 7)[1:]:
            rows.append((family, line, True))
    rows += [(NONE, sentence, n % HELD_OUT == HELD_OUT - 1) for n, sentence in enumerate(ORDINARY)]
    return spark.createDataFrame(rows, "family string, line string, held boolean").select("family", words_of(F.col("line")).alias("words"), "held")


def _softmax(scores: Column, temperature: float) -> Column:
    scaled = F.transform(scores, lambda s: s / F.lit(temperature))
    powers = F.transform(scaled, lambda s: F.exp(s - F.array_max(scaled)))
    return F.transform(powers, lambda p: p / F.aggregate(powers, F.lit(0.0), lambda a, b: a + b))


def _scored(rows: DataFrame, classifier: Classifier) -> DataFrame:
    """Rows plus ``family`` and, for those that are not ``none``, its calibrated ``confidence``."""
    found = classifier.model.transform(with_features(rows, classifier.n_features))
    named = F.element_at(F.array(*[F.lit(f) for f in classifier.families]), F.col("prediction").cast("int") + 1)
    scores = vector_to_array("rawPrediction")
    sure = F.array_max(_softmax(scores, classifier.temperature))
    return found.withColumns({"family": named, "confidence": sure})


def ordinary_segments(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_documents: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """(family, words) of class ``none``: segments of so many different texts, those with the smallest hashes, that hold no licence word and no template."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"), F.xxhash64(whole_text(text)).alias("sample_hash"))
    chosen = rows.select("sample_hash").distinct().orderBy("sample_hash").limit(sample_documents)
    sample = rows.join(F.broadcast(chosen), "sample_hash").groupBy("sample_hash").agg(F.min(F.struct("doc_id", "text")).alias("row")).select("row.*")
    like_licence = F.exists("words", lambda w: w.rlike("^(licen[cs]|copyright|spdx|permission|gpl|warrant)"))
    paired = NGram(n=2, inputCol="words", outputCol="pairs").transform(segments(sample).where(~like_licence))
    templates = F.broadcast(_templates(docs.sparkSession).select("template"))
    return paired.join(templates, _containment() >= MIN_CONTAINMENT, "left_anti").select(F.lit(NONE).alias("family"), "words")


def _carried(lines: DataFrame, ordinary: DataFrame) -> DataFrame:
    """Labelled lines amid the words of ordinary segments, as paragraphs hold them; none if there are no segments. Both are bounded."""
    order = Window.orderBy(F.xxhash64("words"), "words")
    carriers = ordinary.select(F.col("words").alias("around"), (F.row_number().over(order) - 1).alias("at"))
    of = max(carriers.count(), 1)
    placed = lines.withColumn("at", (F.row_number().over(order) - 1) % F.lit(of)).join(F.broadcast(carriers), "at")
    before = (F.pmod(F.xxhash64("words"), F.lit(OVERLAP_WORDS)) + 1).cast("int")
    words = F.concat(F.slice("around", F.lit(1), before), "words", F.slice("around", before + 1, F.lit(SEGMENT_WORDS)))
    start = F.greatest(F.size(F.slice("around", F.lit(1), before)) + F.size("words") - SEGMENT_WORDS, F.lit(0)) + 1
    return placed.select("family", F.slice(words, start, F.lit(SEGMENT_WORDS)).alias("words"), "held")


def train(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    sample_documents: int = SAMPLE_DOCUMENTS,
    n_features: int = FEATURES,
    max_iterations: int = 40,
    max_false_share: float = MAX_FALSE_SHARE,
) -> Classifier:
    """Fit, then calibrate on held-out rows: the temperature of least log loss, and the least confidence with the greatest
    F1 of families, classes weighing alike, that at most ``max_false_share`` of held-out ordinary segments reach.
    """
    spark = docs.sparkSession
    # read three times below
    ordinary = staged(ordinary_segments(docs, doc_id, text, sample_documents), "ordinary-segments")
    held = F.pmod(F.xxhash64("words"), F.lit(HELD_OUT)) == 0
    lines = labelled_rows(spark)
    rows = lines.union(ordinary.select("family", "words", held.alias("held"))).union(_carried(lines.where(F.col("family") != NONE), ordinary))
    families = [NONE, UNKNOWN, *sorted(NAMES)]
    label = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")).cast("double") - 1
    rows = rows.withColumn("label", label)
    # few rows: so few partitions that gradients, which are as long as the model, are added up without a shuffle
    featured = with_features(rows, n_features).select("label", "held", "words", "pairs", "features").coalesce(4).persist()
    counts = {r["label"]: r["n"] for r in featured.where("NOT held").groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    weight = reduce(lambda w, item: w.when(F.col("label") == item[0], F.lit(total / len(counts) / item[1])), counts.items(), F.when(F.lit(False), 1.0))
    regression = LogisticRegression(
        family="multinomial", regParam=1e-4, elasticNetParam=0.0, maxIter=max_iterations, weightCol="weight", standardization=False
    )
    model = regression.fit(featured.where("NOT held").withColumn("weight", weight))
    scored = model.transform(featured.where("held")).select("label", "words", "pairs", vector_to_array("rawPrediction").alias("scores"))
    own = F.col("label").cast("int") + 1
    losses = [F.avg(-F.log(F.greatest(F.element_at(_softmax(F.col("scores"), t), own), F.lit(1e-12)))).alias(f"t{i}") for i, t in enumerate(TEMPERATURES)]
    found = scored.agg(*losses).first()
    ranked = [(loss, t) for loss, t in zip(found, TEMPERATURES, strict=True) if loss is not None]
    temperature = min(ranked)[1] if ranked else 1.0
    chances = _softmax(F.col("scores"), temperature)
    judged = scored.select(F.monotonically_increasing_id().alias("row"), "label", "words", "pairs", chances.alias("p"))
    judged = judged.withColumns({"sure": F.array_max("p"), "named": F.array_position("p", F.array_max("p")) - 1})
    judged = judged.withColumn("family", F.element_at(F.array(*[F.lit(f) for f in families]), F.col("named").cast("int") + 1))
    compared = judged.join(F.broadcast(_templates(spark)), "family", "left").groupBy("row", "label", "sure", "named")
    judged = compared.agg((F.max(F.coalesce(_containment(), F.lit(0.0))) >= MIN_CONTAINMENT).alias("holds"))
    # what a template does not confirm is not reported, however sure
    false = F.when(F.col("holds"), F.col("sure")).otherwise(0.0)
    judged = judged.withColumn("weight", 1.0 / F.count(F.lit(1)).over(Window.partitionBy("label"))).persist()
    reached = judged.where("label = 0").agg(F.percentile(false, F.lit(1.0 - max_false_share))).first()[0] or 0.0
    hit, family = F.col("named") == F.col("label"), (F.col("named") > 1) & F.col("holds")
    def weighed(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("weight")).otherwise(0.0))

    measures = [weighed(c & (F.col("sure") >= t)) for t in THRESHOLDS for c in (family, family & hit)]
    sums = list(judged.agg(weighed(F.col("label") > 1), *measures).first())
    ranked = [(2 * sums[2 * i + 2] / (sums[0] + sums[2 * i + 1]), t) for i, t in enumerate(THRESHOLDS) if sums[0] + sums[2 * i + 1]] if sums[0] else []
    threshold = max([reached, *([max(ranked)[1]] if ranked else [THRESHOLDS[-1]])])
    right, reported = F.col("named") == F.col("label"), (F.col("named") > 1) & F.col("holds") & (F.col("sure") >= threshold)
    report = judged.agg(
        F.try_divide(weighed(reported & right), weighed(reported)).alias("precision"),
        F.try_divide(weighed(reported & right), weighed(F.col("label") > 1)).alias("recall"),
        F.try_divide(F.count_if(~reported & (F.col("label") == 1)), F.count_if(F.col("label") == 1)).alias("unknown_kept"),
    ).first()
    bins = judged.groupBy(F.floor(F.col("sure") * CALIBRATION_BINS)).agg(
        F.count(F.lit(1)).alias("n"), F.abs(F.avg("sure") - F.avg(right.cast("double"))).alias("off")
    )
    error = bins.agg(F.try_divide(F.sum(F.col("n") * F.col("off")), F.sum("n"))).first()[0]
    featured.unpersist()
    judged.unpersist()
    return Classifier(model, families, temperature, threshold, n_features, *report, error)


# scan


def _templates(spark: SparkSession) -> DataFrame:
    """(family, template) with the word pairs of each name, sentence and piece of a paragraph; a few for each row of the lists above."""
    rows = [(f, line) for source in (NAMES, SENTENCES) for f, lines in source.items() for line in lines]
    rows += [(f, piece) for f, lines in PARAGRAPHS.items() for line in lines for piece in _pieces(line)]
    lines = spark.createDataFrame(rows, "family string, line string").select("family", words_of(F.col("line")).alias("words"))
    paired = NGram(n=2, inputCol="words", outputCol="pairs").transform(lines)
    grams = F.when(F.size("words") > 1, F.col("pairs")).otherwise(F.col("words"))
    return paired.select("family", F.array_distinct(grams).alias("template"))


def _containment() -> Column:
    """Share of a template's word pairs, or of its one word, that a segment holds."""
    return F.size(F.array_intersect("template", F.concat("pairs", "words"))) / F.size("template")


def scan(docs: DataFrame, classifier: Classifier, doc_id: str = "doc_id", text: str = "text", min_containment: float = MIN_CONTAINMENT) -> DataFrame:
    """(doc_id, text_hash, paragraph, family, confidence, containment, confirmed): licence-like segments, the best of each family and paragraph."""
    spark = docs.sparkSession
    scored = _scored(segments(docs, doc_id, text), classifier).where(F.col("family") != NONE)
    compared = scored.join(F.broadcast(_templates(spark)), "family", "left").select(
        "doc_id", "text_hash", "paragraph", "family", "confidence",
        F.coalesce(_containment(), F.lit(0.0)).alias("containment"),
    )
    best = compared.groupBy("doc_id", "text_hash", "paragraph", "family").agg(F.max("confidence").alias("confidence"), F.max("containment").alias("containment"))
    confirmed = (F.col("confidence") >= classifier.threshold) & (F.col("containment") >= min_containment)
    return best.withColumn("confirmed", confirmed)


def document_licences(docs: DataFrame, classifier: Classifier, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per row: paragraphs, paragraphs with a confirmed family, those only licence-like (``n_unknown``), and the families, sorted."""
    found = scan(docs, classifier, doc_id, text, **options)
    each = found.groupBy("doc_id", "text_hash", "paragraph").agg(
        F.bool_or("confirmed").alias("named"), F.collect_set(F.when(F.col("confirmed"), F.col("family"))).alias("families")
    )
    grouped = each.groupBy("doc_id", "text_hash").agg(
        F.count_if("named").alias("n_licensed"), F.count_if(~F.col("named")).alias("n_unknown"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("families")))).alias("families"),
    ).withColumnsRenamed({"doc_id": "found_id", "text_hash": "found_hash"})
    whole = whole_text(text)
    worded = F.filter(F.split(whole, BLANK_LINE), lambda line: line.rlike(r"[\p{L}\p{N}]"))
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(whole).alias("text_hash"), F.size(worded).cast("bigint").alias("n_paragraphs")
    )
    same = rows.doc_id.eqNullSafe(grouped.found_id) & (rows.text_hash == grouped.found_hash)
    none = F.lit(0).cast("bigint")
    return rows.join(grouped, same, "left").select(
        "doc_id", "n_paragraphs", F.coalesce("n_licensed", none).alias("n_licensed"), F.coalesce("n_unknown", none).alias("n_unknown"),
        F.coalesce("families", F.array().cast("array<string>")).alias("families"),
    )
