"""License wording as template markup.

Fixed values: published license texts and notices. Between ``<<beginOptional>>`` and
``<<endOptional>>`` stands what may be left out; ``<<var;name=...;words=a-b>>`` stands for
a to b words of any kind. All other words are mandatory; case and punctuation don't count.
"""

from __future__ import annotations

MIT = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including
without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions: The above copyright notice and this permission notice
<<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or
substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<var;name=holders;words=1-20>> BE LIABLE FOR
ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""

ISC = """
Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any
purpose with or without fee is hereby granted, provided that the above copyright notice and this
permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND
<<var;name=author;words=1-20>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var;name=author;words=1-20>> BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF
USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT
OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""

BSD_START = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: <<var;name=bullet;words=0-1>> Redistributions of source code must
retain the above copyright notice, this list of conditions and the following disclaimer.
<<var;name=bullet;words=0-1>> Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided
with the distribution.
"""

BSD_NAMES = """
<<var;name=bullet;words=0-1>> Neither the name of <<var;name=organisation;words=1-20>> nor the names of
its contributors may be used to endorse or promote products derived from this software without specific
prior written permission.
"""

BSD_END = """
THIS SOFTWARE IS PROVIDED BY <<var;name=holders;words=1-20>> "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED.
"""

APACHE = """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at
http<<beginOptional>>s<<endOptional>>://www.apache.org/licenses/LICENSE-2.0
"""

GPL = """
This <<var;name=work;words=1-4>> is free software<<beginOptional>>; you can<<endOptional>> redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation
"""

# Label to what follows "licensed under", "released under" or "distributed under".
NOTICES = {
    "Apache-2.0": "the Apache License<<beginOptional>> Version<<endOptional>> 2.0",
    "BSD-3-Clause": "the <<beginOptional>>3-Clause<<endOptional>> BSD License",
    "CC-BY-4.0": "<<beginOptional>>the<<endOptional>> CC BY 4.0",
    "CC-BY-NC-4.0": "<<beginOptional>>the<<endOptional>> CC BY-NC 4.0",
    "CC-BY-SA-4.0": "<<beginOptional>>the<<endOptional>> CC BY-SA 4.0",
    "GPL-2.0": "<<beginOptional>>the terms of<<endOptional>> the GNU General Public License version 2",
    "GPL-3.0": "<<beginOptional>>the terms of<<endOptional>> the GNU General Public License version 3",
    "MIT": "<<beginOptional>>the terms of<<endOptional>> the MIT License",
}
VERBS = ("licensed", "released", "distributed")

TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", APACHE),
    ("BSD-2-Clause", BSD_START + BSD_END),
    ("BSD-3-Clause", BSD_START + BSD_NAMES + BSD_END),
    ("ISC", ISC),
    ("MIT", MIT),
    ("GPL-2.0", GPL + "; either version 2"),
    ("GPL-3.0", GPL + ", either version 3"),
    *[(label, f"{verb} under {wording}") for label, wording in NOTICES.items() for verb in VERBS],
]
