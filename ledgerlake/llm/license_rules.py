"""Known licence sentences and ordered licence rules (fixed values, from the public licence texts)."""

from __future__ import annotations

# fixed values: identifier -> sentence, lower case, letters and digits only
SENTENCES = {
    "apache.notice": "licensed under the apache license version 2 0",
    "apache.may_not": "you may not use this file except in compliance with the license",
    "apache.obtain": "you may obtain a copy of the license at",
    "apache.as_is": "unless required by applicable law or agreed to in writing software distributed under the license "
                    "is distributed on an as is basis without warranties or conditions of any kind either express or "
                    "implied",
    "apache.see": "see the license for the specific language governing permissions and limitations under the license",
    "apache.the": "licensed under the apache license version 2 0 the license",
    "mit.notice": "released under the mit license",
    "mit.licensed": "licensed under the mit license",
    "mit.name": "the mit license mit",
    "mit.title": "mit license",
    "mit.grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                 "associated documentation files the software to deal in the software without restriction including "
                 "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
                 "copies of the software and to permit persons to whom the software is furnished to do so subject to "
                 "the following conditions",
    "mit.condition": "the above copyright notice and this permission notice shall be included in all copies or "
                     "substantial portions of the software",
    "mit.as_is": "the software is provided as is without warranty of any kind express or implied including but not "
                 "limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "gpl3.notice": "this work is licensed under the gnu general public license version 3",
    "gpl3.title": "gnu general public license version 3 29 june 2007",
    "gpl.free": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                "general public license as published by the free software foundation either version 3 of the license "
                "or at your option any later version",
    "gpl2.free": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                 "general public license as published by the free software foundation either version 2 of the license "
                 "or at your option any later version",
    "gpl.useful": "this program is distributed in the hope that it will be useful but without any warranty without "
                  "even the implied warranty of merchantability or fitness for a particular purpose",
    "lgpl.notice": "licensed under the gnu lesser general public license",
    "agpl.notice": "licensed under the gnu affero general public license version 3",
    "bsd.grant": "redistribution and use in source and binary forms with or without modification are permitted "
                 "provided that the following conditions are met",
    "bsd.source": "redistributions of source code must retain the above copyright notice this list of conditions and "
                  "the following disclaimer",
    "bsd.binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions "
                  "and the following disclaimer in the documentation and or other materials provided with the "
                  "distribution",
    "bsd.endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                   "or promote products derived from this software without specific prior written permission",
    "isc.grant": "permission to use copy modify and or distribute this software for any purpose with or without fee "
                 "is hereby granted provided that the above copyright notice and this permission notice appear in all "
                 "copies",
    "mpl.notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc_by.notice": "licensed under cc by 4 0",
    "cc_by_sa.notice": "licensed under cc by sa 4 0",
    "cc_by_nc.notice": "licensed under cc by nc 4 0",
    "cc0.notice": "licensed under cc0 1 0",
    "cc_by.long": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc_by_nc.long": "this work is licensed under a creative commons attribution noncommercial 4 0 international "
                     "license",
    "unlicense.notice": "this is free and unencumbered software released into the public domain",
    "reserved": "all rights reserved",
}

# fixed values: licence -> rules; a rule's sentences occur in this order
RULES = {
    "AGPL-3.0": [["agpl.notice"]],
    "Apache-2.0": [["apache.notice"], ["apache.the", "apache.may_not", "apache.obtain", "apache.as_is"]],
    "BSD-2-Clause": [["bsd.grant", "bsd.source", "bsd.binary"]],
    "BSD-3-Clause": [["bsd.grant", "bsd.source", "bsd.binary", "bsd.endorse"]],
    "CC-BY-4.0": [["cc_by.notice"], ["cc_by.long"]],
    "CC-BY-NC-4.0": [["cc_by_nc.notice"], ["cc_by_nc.long"]],
    "CC-BY-SA-4.0": [["cc_by_sa.notice"]],
    "CC0-1.0": [["cc0.notice"]],
    "GPL-2.0-or-later": [["gpl2.free", "gpl.useful"]],
    "GPL-3.0": [["gpl3.notice"], ["gpl3.title"], ["gpl.free", "gpl.useful"]],
    "ISC": [["isc.grant"]],
    "LGPL": [["lgpl.notice"]],
    "LicenseRef-all-rights-reserved": [["reserved"]],
    "MIT": [["mit.notice"], ["mit.licensed"], ["mit.name"], ["mit.title", "mit.grant"],
            ["mit.grant", "mit.condition", "mit.as_is"]],
    "MPL-2.0": [["mpl.notice"]],
    "Unlicense": [["unlicense.notice"]],
}

# fixed values: further sentences of the published notices and titles, looked up in ``license_scan.pieces`` only
PUBLISHED = {
    "agpl.free": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                 "affero general public license as published by the free software foundation either version 3 of the "
                 "license or at your option any later version",
    "agpl.title": "gnu affero general public license version 3 19 november 2007",
    "lgpl2.free": "this library is free software you can redistribute it and or modify it under the terms of the gnu "
                  "lesser general public license as published by the free software foundation either version 2 1 of "
                  "the license or at your option any later version",
    "lgpl3.free": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                  "lesser general public license as published by the free software foundation either version 3 of the "
                  "license or at your option any later version",
    "lgpl2.title": "gnu lesser general public license version 2 1 february 1999",
    "lgpl3.title": "gnu lesser general public license version 3 29 june 2007",
    "cc_by.title": "creative commons attribution 4 0 international public license",
    "cc_by_nc.title": "creative commons attribution noncommercial 4 0 international public license",
    "cc_by_sa.title": "creative commons attribution sharealike 4 0 international public license",
    "cc_by_sa.long": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc0.title": "creative commons legal code cc0 1 0 universal",
}
PUBLISHED_RULES = {
    "AGPL-3.0": [["agpl.free"], ["agpl.title"]],
    "CC-BY-4.0": [["cc_by.title"]],
    "CC-BY-NC-4.0": [["cc_by_nc.title"]],
    "CC-BY-SA-4.0": [["cc_by_sa.title"], ["cc_by_sa.long"]],
    "CC0-1.0": [["cc0.title"]],
    "LGPL": [["lgpl2.free"], ["lgpl3.free"], ["lgpl2.title"], ["lgpl3.title"]],
}

#: Every known sentence holds one of these; other sentences need not be looked up.
ANCHORS = ("licen", "permi", "rights reserved", "software", "redistribut", "copyright notice", "public domain", "warrant",
           "under cc")
#: The same for ``PUBLISHED``.
PUBLISHED_ANCHORS = ("licen", "legal code")

assert all(any(a in s for a in ANCHORS) for s in SENTENCES.values())
assert all(i in SENTENCES for rules in RULES.values() for rule in rules for i in rule)
assert all(any(a in s for a in PUBLISHED_ANCHORS) for s in PUBLISHED.values())
assert all(i in PUBLISHED and n in RULES for n, rules in PUBLISHED_RULES.items() for rule in rules for i in rule)
