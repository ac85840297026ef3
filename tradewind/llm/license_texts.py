"""Licence texts and notices, as their licences word them."""

from __future__ import annotations

import re
from dataclasses import dataclass

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@dataclass(frozen=True)
class LicenseText:
    """A text, and the key phrase among its words that a match must have."""

    label: str
    text: str
    key: str

    @property
    def words(self) -> list[str]:
        return _WORD.findall(self.text.lower())

    @property
    def key_words(self) -> list[str]:
        return self.key.split()

    @property
    def key_at(self) -> int:
        words, key = self.words, self.key_words
        return next(i for i in range(len(words)) if words[i : i + len(key)] == key)


_NOTICES = (
    LicenseText("mit", "released under the mit license", "mit license"),
    LicenseText(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        "permission is hereby granted free of charge",
    ),
    LicenseText("apache", "licensed under the apache license", "apache license"),
    LicenseText("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    LicenseText("gpl", "licensed under the gnu general public license", "general public license"),
    LicenseText("gpl-3.0", "this work is licensed under the gnu general public license version 3",
                "gnu general public license version 3"),
    LicenseText("gpl-2.0", "this work is licensed under the gnu general public license version 2",
                "gnu general public license version 2"),
    LicenseText("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    LicenseText("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    LicenseText("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
                "redistribution and use in source and binary forms"),
    LicenseText("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    LicenseText("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    LicenseText("lgpl", "licensed under the gnu library general public license", "gnu library general public license"),
    LicenseText("agpl", "licensed under the gnu affero general public license", "gnu affero general public license"),
    LicenseText("gfdl", "under the terms of the gnu free documentation license", "gnu free documentation license"),
    LicenseText("bsd-2-clause", "licensed under the bsd 2 clause license", "bsd 2 clause"),
    LicenseText("bsd-3-clause", "licensed under the bsd 3 clause license", "bsd 3 clause"),
    LicenseText("isc", "released under the isc license", "isc license"),
    LicenseText("bsl-1.0", "distributed under the boost software license version 1 0", "boost software license"),
    LicenseText("eupl", "licensed under the european union public licence", "european union public licence"),
    LicenseText("eupl", "licensed under the eupl", "licensed under the eupl"),
    LicenseText("epl", "made available under the terms of the eclipse public license", "eclipse public license"),
    LicenseText("cddl", "the common development and distribution license", "common development and distribution license"),
    LicenseText("artistic-2.0", "under the terms of the artistic license 2 0", "artistic license 2 0"),
    LicenseText("ofl-1.1", "this font software is licensed under the sil open font license version 1 1",
                "sil open font license"),
    LicenseText("ms-pl", "under the microsoft public license", "microsoft public license"),
    LicenseText("wtfpl", "do what the fuck you want to public license", "do what the fuck you want to public license"),
    LicenseText("odbl-1.0", "made available under the open database license", "open database license"),
    LicenseText("busl-1.1", "business source license 1 1", "business source license"),
    LicenseText("sspl-1.0", "server side public license version 1", "server side public license"),
    LicenseText("cc0-1.0", "cc0 1 0 universal", "cc0 1 0"),
    LicenseText("cc-by-4.0", "creative commons attribution 4 0 international license",
                "creative commons attribution 4 0"),
    LicenseText("cc-by-sa-4.0", "creative commons attribution sharealike 4 0 international license",
                "creative commons attribution sharealike 4 0"),
    LicenseText("cc-by-nc-4.0", "creative commons attribution noncommercial 4 0 international license",
                "creative commons attribution noncommercial 4 0"),
    LicenseText("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    LicenseText("cc-by-nd-4.0", "licensed under cc by nd 4 0", "cc by nd 4 0"),
)

_MIT = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""

_ISC = """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS
IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""

_BSD = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution.
"""

_BSD_ENDORSEMENT = """
Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
"""

_BSD_ADVERTISING = """
All advertising materials mentioning features or use of this software must display the following acknowledgement
"""

_ZLIB = """
This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but
is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
original software. 3. This notice may not be removed or altered from any source distribution.
"""

_UNLICENSE = """
This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
commercial or non-commercial, and by any means.
"""

_BOOST = """
Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and
transmit the Software, and to prepare derivative works of the Software
"""

_APACHE = """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable
law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License.
"""

_WHOLE = (
    LicenseText("mit", _MIT, "to any person obtaining a copy of this software and associated documentation files"),
    LicenseText("isc", _ISC, "permission to use copy modify and or distribute this software for any purpose"),
    LicenseText("bsd", _BSD, "redistributions of source code must retain the above copyright notice"),
    LicenseText("bsd-3-clause", _BSD_ENDORSEMENT, "may be used to endorse or promote products derived from this software"),
    LicenseText("bsd-4-clause", _BSD_ADVERTISING, "all advertising materials mentioning features or use of this software"),
    LicenseText("zlib", _ZLIB, "the origin of this software must not be misrepresented"),
    LicenseText("unlicense", _UNLICENSE, "free and unencumbered software released into the public domain"),
    LicenseText("bsl-1.0", _BOOST, "to any person or organization obtaining a copy of the software"),
    LicenseText("apache-2.0", _APACHE, "you may not use this file except in compliance with the license"),
)

# Identifiers that stand behind "SPDX-License-Identifier:".
_IDENTIFIERS = """
MIT ISC Apache-2.0 BSD-2-Clause BSD-3-Clause GPL-2.0 GPL-3.0 LGPL-2.1 LGPL-3.0 AGPL-3.0 MPL-2.0 EPL-2.0 EUPL-1.2
BSL-1.0 Unlicense CC0-1.0 CC-BY-SA-4.0 Zlib Artistic-2.0 OFL-1.1 CDDL-1.0 0BSD PostgreSQL
""".split()


def _identifier(name: str) -> LicenseText:
    text = f"SPDX-License-Identifier: {name}"
    return LicenseText(name.lower(), text, " ".join(_WORD.findall(text.lower())))


LICENSES = _NOTICES + _WHOLE + tuple(_identifier(name) for name in _IDENTIFIERS)
