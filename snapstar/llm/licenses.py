"""Licence scans: known sentences to identifiers, identifier sequences to licences. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Normalised licence sentences, as SQL patterns, by identifier. Sentences are lower-case words joined by
#: single spaces, and start where ``START`` cuts: what stands before a reference ("this project is") is another sentence.
SENTENCES = {
    "ApacheRef": "licensed under the apache licen[cs]e,? version 2( 0)?( (?![0-9]).*)?",
    "ApacheUse": "you may not use this file except in compliance with the license( .*)?",
    "ApacheCopy": "you may obtain a copy of the license at.*",
    "ApacheAsIs": "unless required by applicable law or agreed to in writing.*",
    "MitRef": "(released|licensed|distributed) under the mit licen[cs]e( .*)?",
    "BoostGrant": "permission is hereby granted free of charge to any person or organization obtaining a copy.*",
    "BoostNotice": "the copyright notices in the software and this entire statement.*",
    "BoostRef": "(released|licensed|distributed) under the boost software licen[cs]e,? v(ersion )?1 0( .*)?",
    "MitGrant": "permission is hereby granted free of charge to any person obtaining a copy.*",
    "MitNotice": "the above copyright notice and this permission notice( including the next paragraph)? shall be included in.*",
    "MitAsIs": "the software is provided as is without warranty of any kind.*",
    "IscGrant": "permission to use copy modify( and)?( or)? distribute this software for any purpose with or without fee is hereby granted.*",
    "IscNotice": "the above copyright notice and this permission notice appear in all copies( .*)?",
    "IscAsIs": "the software is provided as is and the author disclaims all warranties.*",
    "IscRef": "(released|licensed|distributed) under the isc licen[cs]e( .*)?",
    "Gpl2LaterRef": "licensed under the gnu general public licen[cs]e,? v(ersion )?2( 0)? or (at your option )?(any )?(later|newer)( .*)?",
    "Gpl3LaterRef": "licensed under the gnu general public licen[cs]e,? v(ersion )?3( 0)? or (at your option )?(any )?(later|newer)( .*)?",
    "Gpl2Ref": "licensed under the gnu general public licen[cs]e,? v(ersion )?2( .*)?",
    "Gpl3Ref": "licensed under the gnu general public licen[cs]e,? v(ersion )?3( .*)?",
    "Agpl3Ref": "licensed under the gnu affero general public licen[cs]e,? v(ersion )?3( .*)?",
    "Agpl3Later": "free software you can redistribute it.*gnu affero general public license.* version 3( 0)?( of the license)? or (at your option )?(any )?later.*",
    "Agpl3": "free software you can redistribute it.*gnu affero general public license.* version 3( .*)?",
    "Lgpl2Later": "free software you can redistribute it.*gnu (lesser|library) general public license.* version 2( 0)?( of the license)? or (at your option )?(any )?later.*",
    "Lgpl21Later": "free software you can redistribute it.*gnu (lesser|library) general public license.* version 2 1( of the license)? or (at your option )?(any )?later.*",
    "Lgpl3Later": "free software you can redistribute it.*gnu (lesser|library) general public license.* version 3( 0)?( of the license)? or (at your option )?(any )?later.*",
    "Lgpl21": "free software you can redistribute it.*gnu (lesser|library) general public license.* version 2 1( .*)?",
    "Lgpl2": "free software you can redistribute it.*gnu (lesser|library) general public license.* version 2( .*)?",
    "Lgpl3": "free software you can redistribute it.*gnu (lesser|library) general public license.* version 3( .*)?",
    "LgplFree": "free software you can redistribute it.*gnu (lesser|library) general public license.*",
    "Gpl2Later": "free software you can redistribute it.*gnu general public license.* version 2( 0)?( of the license)? or (at your option )?(any )?later.*",
    "Gpl3Later": "free software you can redistribute it.*gnu general public license.* version 3( 0)?( of the license)? or (at your option )?(any )?later.*",
    "Gpl2": "free software you can redistribute it.*gnu general public license.* version 2( .*)?",
    "Gpl3": "free software you can redistribute it.*gnu general public license.* version 3( .*)?",
    "GplFree": "free software you can redistribute it.*gnu general public license.*",
    "GplHope": "distributed in the hope that it will be useful.*",
    "AgplCopy": "you should have received a copy of the gnu affero general public license.*",
    "LgplCopy": "you should have received a copy of the gnu (lesser|library) general public license.*",
    "GplCopy": "you should have received a copy of the gnu general public license.*",
    "Mpl2Form": "this source code form is subject to the terms of the mozilla public license( .*)?",
    "Mpl2Copy": "if a copy of the mpl was not distributed with this file you can obtain one at( .*)?",
    "Mpl11Form": "the contents of this file are subject to the mozilla public license version 1 1( .*)?",
    "Mpl2Ref": "licensed under the mozilla public licen[cs]e,? v(ersion )?2( .*)?",
    "Epl2Form": "this program and the accompanying materials are made available under the terms of the eclipse public license (v |v|version )?2( .*)?",
    "Epl1Form": "this program and the accompanying materials are made available under the terms of the eclipse public license (v |v|version )?1( .*)?",
    "Epl2Ref": "licensed under the eclipse public licen[cs]e,? (v |v|version )?2( .*)?",
    "ZlibAsIs": "this software is provided as is without any express or implied warranty( .*)?",
    "ZlibGrant": "permission is granted to anyone to use this software for any purpose including commercial applications.*",
    "ZlibOrigin": "the origin of this software must not be misrepresented.*",
    "ZlibAltered": "altered source versions must be plainly marked as such.*",
    "ZlibNotice": "this notice may not be removed or altered from any source distribution( .*)?",
    "ZlibRef": "(released|licensed|distributed) under the zlib licen[cs]e( .*)?",
    "UnlicenseFree": "this is free and unencumbered software released into the public domain( .*)?",
    "UnlicenseAnyone": "anyone is free to copy modify publish use compile sell or distribute this software.*",
    "UnlicenseRef": "(released|licensed|distributed) under the unlicense( .*)?",
    "Cc0Waiver": "to the extent possible under law.* waived all copyright and related or neighbou?ring rights to .*",
    "Cc0Ref": "(released|licensed|distributed) under cc0( .*)?",
    "Bsd3Ref": "(released|licensed|distributed) under the bsd 3 clause licen[cs]e( .*)?",
    "Bsd2Ref": "(released|licensed|distributed) under the bsd 2 clause licen[cs]e( .*)?",
    "BsdGrant": "redistribution and use in source and binary forms with or without modification are permitted.*",
    "BsdSource": "redistributions of source code must retain the above copyright notice.*",
    "BsdBinary": "redistributions in binary form must reproduce the above copyright notice.*",
    "BsdName": "neither the name of.*may be used to endorse or promote products.*",
    "BsdAsIs": "this software is provided by the copyright holders and contributors as is.*",
    "CcByNcRef": "licensed under cc by nc 4( 0)?( (?![0-9]).*)?",
    "CcBySaRef": "licensed under cc by sa 4( 0)?( (?![0-9]).*)?",
    "CcByRef": "licensed under cc by 4( 0)?( (?![0-9]).*)?",
    "Rights": "all rights reserved( .*)?",
}

#: Licences by the sequences of identifiers that state them. A longer rule goes before what it contains.
RULES = [
    ("BSD-3-Clause", "BsdGrant BsdSource BsdBinary BsdName BsdAsIs"),
    ("BSD-2-Clause", "BsdGrant BsdSource BsdBinary BsdAsIs"),
    ("Apache-2.0", "ApacheRef ApacheUse ApacheCopy ApacheAsIs"),
    ("MIT", "MitGrant MitNotice MitAsIs"),
    ("BSL-1.0", "BoostGrant BoostNotice MitAsIs"),
    ("ISC", "IscGrant IscNotice IscAsIs"),
    ("0BSD", "IscGrant IscAsIs"),
    ("Zlib", "ZlibAsIs ZlibGrant ZlibOrigin ZlibAltered ZlibNotice"),
    ("Unlicense", "UnlicenseFree UnlicenseAnyone MitAsIs"),
    ("Unlicense", "UnlicenseFree"),
    ("MPL-2.0", "Mpl2Form Mpl2Copy"),
    ("MPL-1.1", "Mpl11Form"),
    ("EPL-2.0", "Epl2Form"),
    ("EPL-1.0", "Epl1Form"),
    ("CC0-1.0", "Cc0Waiver"),
    ("Apache-2.0", "ApacheRef"),
    ("MIT", "MitRef"),
    ("ISC", "IscRef"),
    ("BSD-3-Clause", "Bsd3Ref"),
    ("BSD-2-Clause", "Bsd2Ref"),
    ("BSL-1.0", "BoostRef"),
    ("Zlib", "ZlibRef"),
    ("Unlicense", "UnlicenseRef"),
    ("MPL-2.0", "Mpl2Ref"),
    ("EPL-2.0", "Epl2Ref"),
    ("GPL-2.0-or-later", "Gpl2LaterRef"),
    ("GPL-3.0-or-later", "Gpl3LaterRef"),
    ("GPL-2.0-only", "Gpl2Ref"),
    ("GPL-3.0-only", "Gpl3Ref"),
    ("AGPL-3.0", "Agpl3Ref"),
    ("CC0-1.0", "Cc0Ref"),
    ("CC-BY-NC-4.0", "CcByNcRef"),
    ("CC-BY-SA-4.0", "CcBySaRef"),
    ("CC-BY-4.0", "CcByRef"),
]
#: Licences by the sentence that grants them, and the one that names them at the end of their notice.
GNU = [
    ("GPL-2.0-or-later", "Gpl2Later", "GplCopy"),
    ("GPL-3.0-or-later", "Gpl3Later", "GplCopy"),
    ("GPL-2.0-only", "Gpl2", "GplCopy"),
    ("GPL-3.0-only", "Gpl3", "GplCopy"),
    ("GPL", "GplFree", "GplCopy"),
    ("LGPL-2.0-or-later", "Lgpl2Later", "LgplCopy"),
    ("LGPL-2.1-or-later", "Lgpl21Later", "LgplCopy"),
    ("LGPL-3.0-or-later", "Lgpl3Later", "LgplCopy"),
    ("LGPL-2.0-only", "Lgpl2", "LgplCopy"),
    ("LGPL-2.1-only", "Lgpl21", "LgplCopy"),
    ("LGPL-3.0-only", "Lgpl3", "LgplCopy"),
    ("LGPL", "LgplFree", "LgplCopy"),
    ("AGPL-3.0-or-later", "Agpl3Later", "AgplCopy"),
    ("AGPL-3.0-only", "Agpl3", "AgplCopy"),
]
RULES += [(name, f"{free} GplHope {copy}") for name, free, copy in GNU] + [(name, f"{free} GplHope") for name, free, _ in GNU]
#: What any known sentence contains; other sentences are not looked at further.
CUES = (
    "licen[cs]|permission|warrant|redistribut|copyright|endorse|reserved|free software|applicable law|"
    "distributed|(?:released|licensed) under|misrepresented|plainly|altered|unencumbered|anyone|disclaims"
)
CUE = f"(?i){CUES}"
#: How the known sentences start.
START = (
    "(?<!not )(?:licensed|released|distributed) under (?:the (?:apache|mit|gnu|isc|bsd|boost|zlib|unlicense|mozilla|eclipse)|cc0?) |you may not use this file |"
    "you may obtain a copy of the license |unless required by applicable law |permission is hereby granted |"
    "the above copyright notice and this permission notice |the software is provided as is |"
    "free software you can redistribute it |distributed in the hope that |you should have received a copy of the gnu |"
    "redistribution and use in source |redistributions (?:of source|in binary) |neither the name of |"
    "this software is provided (?:by|as is without any) |all rights reserved|this source code form is subject to |"
    "if a copy of the mpl was not |the contents of this file are subject to the mozilla |"
    "this program and the accompanying materials are made available |permission to use copy modify |"
    "permission is granted to anyone |the copyright notices in the software and |the origin of this software must |"
    "altered source versions must |this notice may not be |this is free and unencumbered |anyone is free to copy |"
    "to the extent possible under law "
)
#: Parts of a line without a letter or digit of any script: spaces, marks of comments, rules.
BARE = r"[\x00-\x09\x0B-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
#: A sentence ends at a bare line (a blank one, or one of a comment), at . ! ? before white space or the end, unless these
#: start a line, and where a known one starts. Other line feeds only wrap it; marks of comments go as it is normalised.
END = (
    rf"\n(?:{BARE}*+\n)++|(?<![\n.!?])[.!?]+(?=[\x20\x09-\x0D]|$)|"
    rf"(?<![A-Za-z0-9])(?=(?i:{START.replace('not )', 'not[^a-z0-9])').replace(' ', '[^a-z0-9]++')}))"
)


def normalised(sentence: Column) -> Column:
    """Lower case, with anything but a-z, 0-9 and commas as single spaces, and no comma before a space left out."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "), " +", " "))


def _identifier(sentence: Column) -> Column:
    found = F.lit(None).cast("string")
    for name, pattern in reversed(SENTENCES.items()):
        found = F.when(sentence.rlike(f"^{pattern.replace(',?', '')}$"), F.lit(name)).otherwise(found)
    return found


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, sentences, licenses, unmatched): the licence sentences of each whole text in order, and what they state.

    ``sentences`` are identifiers, in order, repeats included. Rules are tried in
    their order, each on what the ones before it left; their identifiers must
    follow one another. ``licenses`` has every licence found, sorted, once each;
    ``unmatched`` the identifiers that no rule took. Null or empty texts have
    empty arrays; a repeated row appears as often as it is given. Sentences may be
    wrapped anywhere, also in a comment, and a reference may stand in a longer one.
    """
    split = F.split(F.coalesce(text, F.lit("")), END)
    known = F.filter(F.transform(F.filter(split, lambda s: s.rlike(CUE)), lambda s: _identifier(normalised(s))), lambda x: x.isNotNull())
    # Without a cue in the text there is nothing to split.
    sentences = F.when(F.col(text).rlike(CUE), known).otherwise(F.array().cast("array<string>"))
    rows = docs.select(id, F.coalesce(sentences, F.array().cast("array<string>")).alias("sentences"))
    rest, found = F.concat(F.lit(" "), F.array_join("sentences", "  "), F.lit(" ")), []
    for license, rule in RULES:
        phrase = "".join(f" {name} " for name in rule.split())
        found.append(F.when(F.contains(rest, F.lit(phrase)), F.lit(license)))
        rest = F.replace(rest, F.lit(phrase), F.lit(" | "))
    licenses = F.array_sort(F.array_distinct(F.array_compact(F.array(*found))))
    left = F.filter(F.split(rest, "[ |]+"), lambda x: x != "")
    return rows.select(id, "sentences", licenses.alias("licenses"), left.alias("unmatched"))


def digest(docs: DataFrame) -> DataFrame:
    """A row for each document: its licences and sentences as text."""
    found = scan(docs)
    return found.select(
        "doc_id",
        F.array_join("licenses", ",").alias("licenses"),
        F.array_join("sentences", ",").alias("sentences"),
        F.size("unmatched").cast("long").alias("n_unmatched"),
    )
