import re
import textwrap

import pytest
from corpus import docs, empty, rows  # noqa: F401

from snapstar.llm import licenses

APACHE = """Licensed under the Apache License, Version 2.0 (x);
you may not use this file except in compliance with the License.
You may obtain a copy of the License at http://example.org/.
Unless required by applicable law or agreed to in writing, software is distributed."""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this.
The above copyright notice and this permission notice shall be included in all copies.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED."""

CASES = [
    ("Some text.\nReleased under the MIT License.\nMore.", "MIT", "MitRef"),
    ("Licensed under the Apache License, Version 2.0.", "Apache-2.0", "ApacheRef"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0-only", "Gpl3Ref"),
    ("x. Licensed under CC BY-NC 4.0. y. All rights reserved.", "CC-BY-NC-4.0", "CcByNcRef,Rights"),
    (MIT, "MIT", "MitGrant,MitNotice,MitAsIs"),
    (APACHE.replace(" (x)", ""), "Apache-2.0", "ApacheRef,ApacheUse,ApacheCopy,ApacheAsIs"),
    ("Released under the MIT License. Licensed under CC BY 4.0.", "CC-BY-4.0,MIT", "MitRef,CcByRef"),
    ("This license is nothing we know. No permission.", "", ""),
    (MIT.split("\n")[0], "", "MitGrant"),
    ("", "", ""),
    (None, "", ""),
]


def test_cases(spark):
    frame = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.digest(frame).collect()}
    for i, (_, names, sentences) in enumerate(CASES):
        assert (found[i].licenses, found[i].sentences) == (names, sentences), CASES[i]
    assert found[8].n_unmatched == 1 and found[3].n_unmatched == 1 and found[4].n_unmatched == 0


def plain(text):
    """The same rules, a sentence and a rule at a time."""
    names = []
    for sentence in re.split(licenses.END, text or ""):
        if re.search(licenses.CUES, sentence, re.I):
            words = re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()
            names += [n for n, p in licenses.SENTENCES.items() if re.fullmatch(p.replace(",?", ""), words)][:1]
    found, rest = set(), list(names)
    for license, rule in licenses.RULES:
        rule, i = rule.split(), 0
        while i + len(rule) <= len(rest):
            if rest[i : i + len(rule)] == rule:
                found.add(license)
                rest[i : i + len(rule)] = [None]
            i += 1
    return ",".join(sorted(found)), ",".join(names), sum(n is not None for n in rest)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_table_against_plain_version(spark, sf):
    table = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in table.collect()}
    found = {r.doc_id: (r.licenses, r.sentences, r.n_unmatched) for r in licenses.digest(table).collect()}
    assert found == {id: plain(text) for id, text in texts.items()}
    assert any(v[0] for v in found.values())


def test_hard_rows(docs, empty):  # noqa: F811
    assert licenses.digest(docs).count() == len(rows())
    assert licenses.digest(empty).count() == 0


GPL = """This program is free software{0} you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any
later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty
of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program{0} if not, write to the Free
Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."""
LGPL = GPL.replace("program", "library").replace("GNU General\n", "GNU Lesser General ").replace("GNU General", "GNU Lesser General")
AGPL = LGPL.replace("Lesser", "Affero").replace("version 2", "version 3")
LATER = """version 2 of the License, or (at your option) any
later version."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
EPL = """This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is
available at https://www.eclipse.org/legal/epl-2.0/"""
ISC = """Copyright (c) 2020, The Owner

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS."""
BOOST = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce and distribute it, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, must be included in all copies of
the Software, in whole or in part.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author dedicates any copyright interest in the software to the public domain.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED."""
CC0 = """To the extent possible under law, The Owner has waived all copyright and related or neighboring rights to this work."""
BSD = """Copyright (c) 2020, The Owner
All rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
{0}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY ARE DISCLAIMED."""
NAME = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
"""
FULL_MIT = """Copyright (c) 2020 The Owner

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED."""
FULL_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS
IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""
NOTICES = [
    (GPL.format(";"), "GPL-2.0-or-later", "Gpl2Later,GplHope,GplCopy"),
    (GPL.format(":"), "GPL-2.0-or-later", "Gpl2Later,GplHope,GplCopy"),
    (GPL.format(":").replace("version 2", "version 3"), "GPL-3.0-or-later", "Gpl3Later,GplHope,GplCopy"),
    (GPL.format(";").replace(LATER, "version 2."), "GPL-2.0-only", "Gpl2,GplHope,GplCopy"),
    (GPL.format(";").replace("; either " + LATER, "."), "GPL", "GplFree,GplHope,GplCopy"),
    (LGPL.format(";"), "LGPL-2.0-or-later", "Lgpl2Later,GplHope,LgplCopy"),
    (LGPL.format(";").replace("version 2", "version 2.1"), "LGPL-2.1-or-later", "Lgpl21Later,GplHope,LgplCopy"),
    (LGPL.format(";").replace(LATER, "version 2.1."), "LGPL-2.1-only", "Lgpl21,GplHope,LgplCopy"),
    (LGPL.format(";").replace("version 2", "version 3"), "LGPL-3.0-or-later", "Lgpl3Later,GplHope,LgplCopy"),
    (LGPL.format(";").replace("; either " + LATER, "."), "LGPL", "LgplFree,GplHope,LgplCopy"),
    (AGPL.format(":"), "AGPL-3.0-or-later", "Agpl3Later,GplHope,AgplCopy"),
    (MPL, "MPL-2.0", "Mpl2Form,Mpl2Copy"),
    (EPL, "EPL-2.0", "Epl2Form"),
    (ISC, "ISC", "IscGrant,IscNotice,IscAsIs"),
    (ISC.replace(", provided that the above copyright notice and this permission notice appear in all copies", ""), "0BSD", "IscGrant,IscAsIs"),
    (BOOST, "BSL-1.0", "BoostGrant,BoostNotice,MitAsIs"),
    (ZLIB, "Zlib", "ZlibAsIs,ZlibGrant,ZlibOrigin,ZlibAltered,ZlibNotice"),
    (UNLICENSE, "Unlicense", "UnlicenseFree,UnlicenseAnyone,MitAsIs"),
    (CC0, "CC0-1.0", "Cc0Waiver"),
    (BSD.format(""), "BSD-2-Clause", "Rights,BsdGrant,BsdSource,BsdBinary,BsdAsIs"),
    (BSD.format(NAME), "BSD-3-Clause", "Rights,BsdGrant,BsdSource,BsdBinary,BsdName,BsdAsIs"),
    (FULL_MIT, "MIT", "MitGrant,MitNotice,MitAsIs"),
    (FULL_APACHE, "Apache-2.0", "ApacheRef,ApacheUse,ApacheCopy,ApacheAsIs"),
]
WITHIN = [
    ("This project is licensed under the MIT License and comes as it is.", "MIT", "MitRef"),
    ("A tool\nlicensed under the GNU General Public License, version 3.0, by us", "GPL-3.0-only", "Gpl3Ref"),
    ("Released under the MIT License\nText is licensed under CC BY 4.0\nAll rights\nreserved\nNext", "CC-BY-4.0,MIT", "MitRef,CcByRef,Rights"),
    ("It is not licensed under the MIT License. Licensed under the Apache License, Version 2.1", "", ""),
    ("Licensed under the GNU General Public License, version 2 or later, by us.", "GPL-2.0-or-later", "Gpl2LaterRef"),
    ("Code is released under the ISC license. Data: released under CC0.", "CC0-1.0,ISC", "IscRef,Cc0Ref"),
    ("Anyone is free to copy this. It was distributed and altered.", "", ""),
]


def wrapped(text, width, mark, line="\n"):
    """Paragraphs filled again at a width, each line after the mark of a comment; blank lines have the mark alone."""
    parts = [textwrap.wrap(p, width) for p in text.split("\n\n")]
    return line.join(mark + x for p in parts for x in [*p, ""])


def test_canonical_notices_at_any_width(spark):
    shapes = [(w, m, e) for w in (20, 40, 72, 79, 2000) for m in ("", "# ", " * ", "! ", "; ") for e in ("\n", "\r\n")]
    cases = [(wrapped(t, *s), *rest) for t, *rest in NOTICES for s in shapes] + WITHIN
    frame = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "doc_id long, text string")
    found = {r.doc_id: (r.licenses, r.sentences, r.n_unmatched) for r in licenses.digest(frame).collect()}
    for i, (text, names, sentences) in enumerate(cases):
        assert found[i] == (names, sentences, sentences.count("Rights")), text
        assert found[i] == plain(text)
