"""Signature rules for licences, over lower-case words joined by one blank.

A licence is stated once: its label and patterns for its name, its short identifier and the address
of its text. ``rules()`` makes the grant, identifier, address and title rules of every licence from
these, and adds sentences that stand in licence texts themselves. Each rule names a literal that
every match contains; a text without it is never searched for the rule.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    name: str
    label: str
    keyword: str
    pattern: str
    priority: int


# label; literal in the name; name; identifier; address of the text
LICENSES = (
    ("apache-2.0", "apache", r"apache(?: software)? licen[sc]e(?: version)? 2(?: 0)?", "apache 2 0", "apache org licenses license 2 0"),
    ("apache-1.1", "apache", r"apache(?: software)? licen[sc]e(?: version)? 1 1", "apache 1 1", "apache org licenses license 1 1"),
    ("mit", "mit", r"mit(?: x11)? licen[sc]e", "mit", "opensource org licenses mit"),
    ("mit-0", "mit", r"mit no attribution(?: licen[sc]e)?", "mit 0", "opensource org licenses mit 0"),
    ("x11", "x11", r"x11 licen[sc]e", "x11", "spdx org licenses x11"),
    ("bsd-2-clause", "bsd", r"(?:2 clause bsd|simplified bsd|bsd 2 clause|freebsd)(?: licen[sc]e)?", "bsd 2 clause", "opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(?:3 clause bsd|new bsd|modified bsd|bsd 3 clause)(?: licen[sc]e)?", "bsd 3 clause", "opensource org licenses bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(?:4 clause bsd|original bsd|bsd 4 clause)(?: licen[sc]e)?", "bsd 4 clause", "spdx org licenses bsd 4 clause"),
    ("0bsd", "bsd", r"(?:zero clause bsd|0bsd|bsd zero clause)(?: licen[sc]e)?", "0bsd", "opensource org licenses 0bsd"),
    ("bsd", "bsd", r"bsd(?: style)? licen[sc]e", "bsd", "opensource org licenses bsd license"),
    ("isc", "isc", r"isc licen[sc]e", "isc", "opensource org licenses isc"),
    ("gpl-2.0", "general public", r"(?:gnu )?general public licen[sc]e (?:version )?v?2(?: 0)?", "gpl 2 0", "gnu org licenses old licenses gpl 2 0"),
    ("gpl-3.0", "general public", r"(?:gnu )?general public licen[sc]e (?:version )?v?3(?: 0)?", "gpl 3 0", "gnu org licenses gpl 3 0"),
    ("gpl-2.0", "gpl", r"(?:gnu )?gpl ?(?:version )?v?2(?: 0)?", "gplv2", "gnu org licenses gpl2"),
    ("gpl-3.0", "gpl", r"(?:gnu )?gpl ?(?:version )?v?3(?: 0)?", "gplv3", "gnu org licenses gpl html"),
    ("lgpl-2.1", "general public", r"(?:gnu )?(?:lesser|library) general public licen[sc]e (?:version )?v?2(?: [01])?", "lgpl 2 1", "gnu org licenses old licenses lgpl 2 1"),
    ("lgpl-3.0", "general public", r"(?:gnu )?lesser general public licen[sc]e (?:version )?v?3(?: 0)?", "lgpl 3 0", "gnu org licenses lgpl 3 0"),
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public licen[sc]e(?: (?:version )?v?3(?: 0)?)?", "agpl 3 0", "gnu org licenses agpl 3 0"),
    ("gfdl-1.3", "documentation", r"(?:gnu )?free documentation licen[sc]e(?: (?:version )?1 3)?", "gfdl 1 3", "gnu org licenses fdl 1 3"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[sc]e (?:version |v )?2(?: 0)?", "mpl 2 0", "mozilla org mpl 2 0"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[sc]e (?:version |v )?1 1", "mpl 1 1", "mozilla org mpl 1 1"),
    ("epl-2.0", "eclipse", r"eclipse public licen[sc]e (?:version |v )?2(?: 0)?", "epl 2 0", "eclipse org legal epl 2 0"),
    ("epl-1.0", "eclipse", r"eclipse public licen[sc]e (?:version |v )?1(?: 0)?", "epl 1 0", "eclipse org legal epl v10"),
    ("cddl-1.0", "distribution", r"common development and distribution licen[sc]e(?: (?:version )?1 0)?", "cddl 1 0", "opensource org licenses cddl 1 0"),
    ("eupl-1.2", "european union", r"european union public licen[sc]e(?: (?:version |v )?1 2)?", "eupl 1 2", "joinup ec europa eu collection eupl"),
    ("artistic-2.0", "artistic", r"artistic licen[sc]e(?: (?:version )?2 0)?", "artistic 2 0", "opensource org licenses artistic license 2 0"),
    ("bsl-1.0", "boost", r"boost software licen[sc]e(?: (?:version )?1 0)?", "bsl 1 0", "boost org license 1 0"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[sc]e", "zlib", "opensource org licenses zlib"),
    ("unlicense", "unlicense", r"(?:the )?unlicense", "unlicense", "unlicense org"),
    ("wtfpl", "wtfpl", r"wtfpl", "wtfpl", "wtfpl net"),
    ("psf-2.0", "python", r"python software foundation licen[sc]e(?: (?:version )?2(?: 0)?)?", "psf 2 0", "docs python org 3 license"),
    ("postgresql", "postgresql", r"postgresql licen[sc]e", "postgresql", "postgresql org about licence"),
    ("openssl", "openssl", r"openssl licen[sc]e", "openssl", "openssl org source license"),
    ("php-3.01", "php", r"php licen[sc]e(?: (?:version )?3 01)?", "php 3 01", "php net license 3 01"),
    ("ruby", "ruby", r"ruby licen[sc]e", "ruby", "ruby lang org en about license"),
    ("ms-pl", "microsoft", r"microsoft public licen[sc]e", "ms pl", "opensource org licenses ms pl"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[sc]e", "ms rl", "opensource org licenses ms rl"),
    ("ofl-1.1", "open font", r"(?:sil )?open font licen[sc]e(?: (?:version )?1 1)?", "ofl 1 1", "scripts sil org ofl"),
    ("odbl-1.0", "open database", r"open database licen[sc]e(?: (?:version |v )?1 0)?", "odbl 1 0", "opendatacommons org licenses odbl"),
    ("odc-by-1.0", "open data commons", r"open data commons attribution licen[sc]e", "odc by 1 0", "opendatacommons org licenses by"),
    ("pddl-1.0", "public domain", r"public domain dedication and licen[sc]e", "pddl 1 0", "opendatacommons org licenses pddl"),
    ("cdla-permissive-2.0", "community data", r"community data licen[sc]e agreement permissive", "cdla permissive 2 0", "cdla dev permissive 2 0"),
    ("ogl-uk-3.0", "open government", r"open government licen[sc]e(?: v?3(?: 0)?)?", "ogl uk 3 0", "nationalarchives gov uk doc open government licence"),
    ("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?", "cc0 1 0", "creativecommons org publicdomain zero 1 0"),
    ("cc-by", "attribution", r"creative commons attribution(?: [1-4] [0-9])?(?: international| unported| generic)?(?: licen[sc]e)?", "cc by 4 0", "creativecommons org licenses by [1-4] [0-9]"),
    ("cc-by", "cc by", r"cc by(?: [1-4] [0-9])?", "cc by 3 0", "creativecommons org licenses by 3 0"),
    ("cc-by-sa", "attribution", r"creative commons attribution share ?alike(?: [1-4] [0-9])?(?: international| unported| generic)?(?: licen[sc]e)?", "cc by sa 4 0", "creativecommons org licenses by sa"),
    ("cc-by-sa", "cc by sa", r"cc by sa(?: [1-4] [0-9])?", "cc by sa 3 0", "creativecommons org licenses by sa 3 0"),
    ("cc-by-nc", "attribution", r"creative commons attribution non ?commercial(?: [1-4] [0-9])?(?: international| unported| generic)?(?: licen[sc]e)?", "cc by nc 4 0", "creativecommons org licenses by nc [1-4] [0-9]"),
    ("cc-by-nc", "cc by nc", r"cc by nc(?: [1-4] [0-9])?", "cc by nc 3 0", "creativecommons org licenses by nc 3 0"),
    ("cc-by-nd", "attribution", r"creative commons attribution no ?deriv(?:ative)?s(?: works)?(?: [1-4] [0-9])?(?: international| unported| generic)?(?: licen[sc]e)?", "cc by nd 4 0", "creativecommons org licenses by nd"),
    ("cc-by-nd", "cc by nd", r"cc by nd(?: [1-4] [0-9])?", "cc by nd 3 0", "creativecommons org licenses by nd 3 0"),
    ("cc-by-nc-sa", "attribution", r"creative commons attribution non ?commercial share ?alike(?: [1-4] [0-9])?(?: international| unported| generic)?(?: licen[sc]e)?", "cc by nc sa 4 0", "creativecommons org licenses by nc sa"),
    ("cc-by-nc-sa", "cc by nc sa", r"cc by nc sa(?: [1-4] [0-9])?", "cc by nc sa 3 0", "creativecommons org licenses by nc sa 3 0"),
    ("cc-by-nc-nd", "attribution", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: works)?(?: [1-4] [0-9])?(?: international| unported| generic)?(?: licen[sc]e)?", "cc by nc nd 4 0", "creativecommons org licenses by nc nd"),
    ("cc-by-nc-nd", "cc by nc nd", r"cc by nc nd(?: [1-4] [0-9])?", "cc by nc nd 3 0", "creativecommons org licenses by nc nd 3 0"),
)

# name, label, literal, pattern, priority
SENTENCES = (
    ("reserved", "reserved", "all rights reserved", r"all rights reserved", 40),
    ("reserved-named", "reserved", "all rights reserved", r"copyright(?: c)?(?: \S+){1,8} all rights reserved", 60),
    ("some-reserved", "some-rights-reserved", "some rights reserved", r"some rights reserved", 45),
    ("copyright-year", "copyright", "copyright", r"copyright(?: c)? (?:19|20)[0-9]{2}", 35),
    ("gpl-any", "gpl", "general public", r"(?:gnu )?general public licen[sc]e", 50),
    ("gpl-later", "gpl-or-later", "later version", r"or(?: at your option)? any later version", 45),
    ("public-domain", "public-domain", "public domain", r"(?:in|into|to) the public domain", 55),
    ("mit-text", "mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy", 85),
    ("isc-text", "isc", "permission to use copy", r"permission to use copy modify and or distribute this software for any purpose", 85),
    ("bsd-text", "bsd", "redistribution and use", r"redistribution and use in source and binary forms", 80),
    ("bsd-3-text", "bsd-3-clause", "endorse or promote", r"may be used to endorse or promote products derived from this software", 82),
    ("bsd-4-text", "bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software", 82),
    ("warranty", "no-warranty", "warrant", r"without warrant(?:y|ies) of any kind", 40),
    ("as-is", "no-warranty", "as is", r"provided(?: by \S+(?: \S+){0,6})? as is", 38),
    ("zlib-text", "zlib", "must not be misrepresented", r"the origin of this software must not be misrepresented", 82),
    ("unlicense-text", "unlicense", "unencumbered software", r"free and unencumbered software released into the public domain", 86),
    ("wtfpl-text", "wtfpl", "what the fuck you want", r"do what the fuck you want to public licen[sc]e", 86),
    ("no-derivatives", "no-derivatives", "derivative", r"no derivative works", 45),
    ("non-commercial", "non-commercial", "commercial", r"for non ?commercial (?:use|purposes)(?: only)?", 50),
    ("proprietary", "proprietary", "proprietary", r"(?:confidential and proprietary|proprietary and confidential)", 60),
    ("reproduced", "reserved", "prior written permission", r"without(?: the)?(?: express)? prior written permission", 48),
)

_GRANT = (
    r"(?:licen[sc]ed|released|distributed|available|provided|published|redistributed|offered|governed)"
    r" (?:under|by)(?: the)?(?: terms of)?(?: the)?(?: gnu)? "
)


def rules() -> list[Rule]:
    """All rules, in order: of two that agree in priority and place, the earlier one stays."""
    made = []
    for number, (label, literal, name, identifier, address) in enumerate(LICENSES):
        made += [
            Rule(f"id-{number}", label, "spdx license identifier",
                 f"spdx license identifier {identifier}(?: only| or later)?", 100),
            Rule(f"address-{number}", label, address.split(" [")[0], address, 95),
            Rule(f"grant-{number}", label, literal, f"{_GRANT}{name}", 90),
            Rule(f"title-{number}", label, literal, name, 70),
        ]
    return made + [Rule(*sentence) for sentence in SENTENCES]


# Text without any of these literals matches no rule and no base phrase (tests check every rule).
GATES = (
    "licen", "spdx", "cc", "creative", "attribution", "bsd", "gpl", "wtfpl", "mozilla", "eclipse",
    "boost", "joinup", "ofl", "cdla", "copyright", "reserved", "later", "public", "permission",
    "redistribution", "endorse", "advertising", "warrant", "provided", "misrepresented",
    "unencumbered", "derivative", "commercial", "proprietary",
)
