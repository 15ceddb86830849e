"""Texts and notices of licenses, as they are published. Fixed values."""

from __future__ import annotations

_NO_WARRANTY = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
_ISC_WARRANTY = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
_BSD_WARRANTY = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_MIT_GRANT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so'
_MIT_NOTICE = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_BSD_FORMS = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_ONE = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BSD_TWO = "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAME = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_LINE = "Copyright (c) <year> <holder>"
_FSF = "This {what} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation{comma} either version {n} of the License, or (at your option) any later version.\n\nThis {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details.\n\n{end}"
_SEE = "You should have received a copy of the GNU {name} along with this program. If not, see <https://www.gnu.org/licenses/>."
_WRITE = "You should have received a copy of the GNU {name} along with this {what}; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."
_GPL, _AGPL, _LGPL = "General Public License", "Affero General Public License", "Lesser General Public License"


def _gnu(what: str, name: str, n: str, new: bool) -> str:
    """The notice of the third versions (new) or of earlier ones."""
    return _FSF.format(what=what, name=name, n=n, mark=":" if new else ";", comma="," if new else ";", end=(_SEE if new else _WRITE).format(name=name, what=what))


#: Whole texts, and the notices that stand for the longest ones at the head of files.
TEXTS = (
    ("MIT", f"MIT License\n\n{_LINE}\n\n{_MIT_GRANT}, subject to the following conditions:\n\n{_MIT_NOTICE}\n\n{_NO_WARRANTY}"),
    ("MIT", f"The MIT License (MIT)\n\n{_LINE}\n\n{_MIT_GRANT}, subject to the following conditions:\n\n{_MIT_NOTICE}\n\n{_NO_WARRANTY}"),
    ("MIT", f"{_LINE}\n\n{_MIT_GRANT}, subject to the following conditions:\n\n{_MIT_NOTICE}\n\n{_NO_WARRANTY}"),
    ("MIT-0", f"MIT No Attribution\n\n{_LINE}\n\n{_MIT_GRANT}.\n\n{_NO_WARRANTY}"),
    ("JSON", f"{_LINE}\n\n{_MIT_GRANT}, subject to the following conditions:\n\n{_MIT_NOTICE}\n\nThe Software shall be used for Good, not Evil.\n\n{_NO_WARRANTY}"),
    ("ISC", f"ISC License\n\n{_LINE}\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_WARRANTY}"),
    ("ISC", f"{_LINE}\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_WARRANTY}"),
    ("ISC", f"{_LINE}\n\nPermission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_WARRANTY}"),
    ("0BSD", f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n{_ISC_WARRANTY}"),
    ("Zlib", f"{_LINE}\n\nThis software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n3. This notice may not be removed or altered from any source distribution."),
    ("BSD-2-Clause", f"BSD 2-Clause License\n\n{_LINE}\n\n{_BSD_FORMS}\n\n{_BSD_ONE}\n\n{_BSD_TWO}\n\n{_BSD_WARRANTY}"),
    ("BSD-2-Clause", f"{_LINE}\n\n{_BSD_FORMS}\n\n{_BSD_ONE}\n\n{_BSD_TWO}\n\n{_BSD_WARRANTY}"),
    ("BSD-3-Clause", f"BSD 3-Clause License\n\n{_LINE}\n\n{_BSD_FORMS}\n\n{_BSD_ONE}\n\n{_BSD_TWO}\n\n3. {_BSD_NAME}\n\n{_BSD_WARRANTY}"),
    ("BSD-3-Clause", f"{_LINE}\n\n{_BSD_FORMS}\n\n{_BSD_ONE}\n\n{_BSD_TWO}\n\n3. {_BSD_NAME}\n\n{_BSD_WARRANTY}"),
    ("BSD-3-Clause", f"{_LINE}\n\n{_BSD_FORMS}\n\n* {_BSD_ONE[3:]}\n\n* {_BSD_TWO[3:]}\n\n* {_BSD_NAME}\n\n{_BSD_WARRANTY}"),
    ("BSL-1.0", 'Boost Software License - Version 1.0 - August 17th, 2003\n\nPermission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:\n\nThe copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("Unlicense", 'This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n\nIn jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.\n\nFor more information, please refer to <https://unlicense.org>'),
    ("WTFPL", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE\nVersion 2, December 2004\n\nCopyright (C) 2004 Sam Hocevar <sam@hocevar.net>\n\nEveryone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.\n\nDO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE\nTERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION\n\n0. You just DO WHAT THE FUCK YOU WANT TO."),
    ("curl", f'{_LINE}\n\nAll rights reserved.\n\nPermission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT OF THIRD PARTY RIGHTS. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.\n\nExcept as contained in this notice, the name of a copyright holder shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software without prior written authorization of the copyright holder.'),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("GPL-2.0-or-later", _gnu("program", _GPL, "2", False)),
    ("GPL-3.0-or-later", _gnu("program", _GPL, "3", True)),
    ("AGPL-3.0-or-later", _gnu("program", _AGPL, "3", True)),
    ("LGPL-2.1-or-later", _gnu("library", _LGPL, "2.1", False)),
    ("LGPL-3.0-or-later", _gnu("program", _LGPL, "3", True)),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty.\n\nYou should have received a copy of the CC0 Public Domain Dedication along with this software. If not, see <http://creativecommons.org/publicdomain/zero/1.0/>."),
)

#: Digests (see ``licenses.digest``, with either kind of line left out) of long texts as published, whole and without what follows their terms. Fixed values.
DIGESTS = (
    ("Apache-2.0", "0d5838e6f6e5a374e58d608af5c01bc6a67cf18552dd7b346e5aef652b808ee9"),
    ("Apache-2.0", "adf220ee02537f83220e088f4488ca0e7557d614fac1cc48967b41d13911d6e0"),
    ("Apache-2.0", "0933e9fdf25f8a4aced10e10246650350123e13b939182f69b5ec6730ce2d793"),
    ("Apache-2.0", "9446b99128ec9c3946adbb681853599f3a5f01a69d6c0762a9d0ab699868d801"),
    ("Artistic-1.0-Perl", "f273930184a9b8de03336e9ae5d74bef291165524044f55455ee5117f494811a"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("CC0-1.0", "cccf7894e1b9f4ba9f97728bf0c5baf9e07bc2ac93da7a51556451b1fb2b868e"),
    ("GFDL-1.2", "19d29a7c800a0d85704b63b4c09d5cd01dd9a287c61e238f4717d8a9e75d214f"),
    ("GFDL-1.2", "15f6a8d360ffdecc988c29279c00f23e20de17f14f2a06572ab0d41de6e98b7b"),
    ("GFDL-1.3", "e70f40f3a50995855f972521fe4eaa4af360a4597e5914977b6093cce5243480"),
    ("GFDL-1.3", "2d36daeff2ad303badb6dee8149748be25e22974dd468e1e8a55cf40f16fc01d"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-1.0", "d98bca1875592c382caba655043aec268528bc17c9d7c0a9e892b953378effa6"),
    ("GPL-1.0", "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc"),
    ("GPL-1.0", "9679cb8f8a7c25e849b925136d793d1bec010b8b9270e6ba898e2cefcb3e1f6d"),
    ("GPL-2.0", "b866f5427b78991db8012466b32f51c907f5e974fde5129a47372d0d0552e3a1"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-2.0", "e4d14510e41435c3eb12c255b72546a3cb9943f06f209c72bc30a19095b08999"),
    ("GPL-2.0", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34"),
    ("GPL-3.0", "010ce52b3b970c80b5447205f4afc3b42084811cda2d11b95178b1fd3940764f"),
    ("GPL-3.0", "868c1e600def196be5dd1320b950766073091019680fa4d672c4b6f5a7bd4831"),
    ("GPL-3.0", "3dcf77ad8c25248618918aaff1de8a2cb80cea6ca922ef4a7a389cca96a7560b"),
    ("GPL-3.0", "7300741b7882c4cee1198306545302285397b5dbcfa263d41588b8b85e01aefd"),
    ("LGPL-2.0", "e2c319279ddf282349927826fd110bdb5b471edc3a726a66fe333c8184a4b135"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.0", "a07313094d4e63b099417491ebc80c933bf85c36d5afddbf13be9a11457c8513"),
    ("LGPL-2.0", "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260"),
    ("LGPL-2.1", "13cd11e9ccd3aae212d64d9b0f62b3a67f21019c6a65212e582b2cbbeb91cb70"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-2.1", "bfe8e5dc6cef43d0c4777d9c1891f596159cda682ef40545ad2105f66b9746f1"),
    ("LGPL-2.1", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("LGPL-3.0", "11a7eabf884f5575b70a6cff6628e05126a0a629a3b4fb202a995d21f65452b8"),
    ("MPL-1.1", "fcb579371133afd771fed87cd5d8c6dc5648746c9945d4adf08ec5c79aba5c61"),
    ("MPL-1.1", "cde502723475871fa8202e9364da5099cbc19700ddffc9b6da43c91023761c56"),
    ("MPL-2.0", "9e79a7d513376f6fa1500e4df4f6276c6e7e61c5c3e28dcdb1acee24033acc56"),
    ("MPL-2.0", "d93233202a0668a0f31517049a3528a401f8f1f11163fb748b48624e00a39a1c"),
)

#: Notices of one line.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
)
