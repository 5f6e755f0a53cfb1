"""Hand-written license signatures, in order: priority, label, keyword and pattern per line.

Patterns run over a text's words (lower case, one blank between words; marks are gone, so
"Version 2.0" reads "version 2 0"). Priority 1 is the wording of a license or of its grant, 2 a
machine-readable tag, 3 a name with its version, 4 a bare name.
"""

SIGNATURES = r"""
4 ; mit ; license ; mit license
4 ; apache ; license ; apache license
4 ; gpl ; license ; general public license
1 ; mit ; permission ; permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
1 ; mit ; copies ; the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
1 ; mit ; license ; (?:released|licensed|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the )?(?:mit|expat|x11) license
2 ; mit ; spdx ; spdx license identifier mit
3 ; mit ; license ; license mit
3 ; mit ; licensed ; mit licensed
3 ; mit ; licence ; mit licence
4 ; mit ; license ; expat license
4 ; x11 ; license ; x11 license
2 ; x11 ; spdx ; spdx license identifier x11
1 ; mit-0 ; attribution ; mit no attribution(?: license)?
2 ; mit-0 ; spdx ; spdx license identifier mit 0
1 ; mit-advertising ; advertising ; mit license with (?:the )?advertising clause
1 ; apache-2.0 ; apache ; licensed under the apache license version 2 0(?: the license)?
1 ; apache-2.0 ; license ; you may not use this file except in compliance with the license
1 ; apache-2.0 ; apache ; (?:released|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the )?apache(?: software)? license(?: version)?(?: v)? ?2(?: 0)?
1 ; apache-2.0 ; license ; unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
2 ; apache-2.0 ; spdx ; spdx license identifier apache 2 0
3 ; apache-2.0 ; apache ; apache(?: software)? licen[sc]e (?:version |v )?2(?: 0)?
3 ; apache-2.0 ; apache ; apache licen[sc]e v2(?: 0)?
3 ; apache-2.0 ; license ; license apache 2 0
3 ; apache-2.0 ; licensed ; apache 2 0 licensed
3 ; apache-1.1 ; apache ; apache software license version 1 1
2 ; apache-1.1 ; spdx ; spdx license identifier apache 1 1
3 ; apache-1.0 ; apache ; apache (?:software )?license version 1 0
2 ; apache-1.0 ; spdx ; spdx license identifier apache 1 0
4 ; apache ; apache ; apache licence
4 ; apache ; apache ; apache licensed
1 ; gpl-3.0 ; license ; (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?general public license version 3
1 ; gpl-3.0-or-later ; license ; gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version
1 ; gpl-3.0 ; license ; gnu general public license as published by the free software foundation version 3
1 ; gpl-2.0-or-later ; license ; gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version
1 ; gpl-2.0 ; license ; gnu general public license as published by the free software foundation version 2
1 ; gpl-2.0 ; license ; (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?general public license version 2
1 ; gpl-1.0-or-later ; license ; gnu general public license as published by the free software foundation either version 1 or at your option any later version
1 ; gpl ; license ; you should have received a copy of the gnu general public license along with this program
1 ; gpl ; warranty ; this program comes with absolutely no warranty
1 ; gpl ; free software ; this is free software and you are welcome to redistribute it under certain conditions
2 ; gpl-3.0-or-later ; spdx ; spdx license identifier gpl 3 0 or later
2 ; gpl-3.0 ; spdx ; spdx license identifier gpl 3 0(?: only)?
2 ; gpl-2.0-or-later ; spdx ; spdx license identifier gpl 2 0 or later
2 ; gpl-2.0 ; spdx ; spdx license identifier gpl 2 0(?: only)?
2 ; gpl-1.0 ; spdx ; spdx license identifier gpl 1 0(?: only)?
3 ; gpl-3.0 ; license ; gnu general public license(?: gpl)? (?:version |v )?3(?: 0)?
3 ; gpl-2.0 ; license ; gnu general public license(?: gpl)? (?:version |v )?2(?: 0)?
3 ; gpl-1.0 ; license ; gnu general public license(?: gpl)? (?:version |v )?1(?: 0)?
3 ; gpl-3.0 ; gpl ; gplv3
3 ; gpl-3.0-or-later ; gpl ; gplv3 or later
3 ; gpl-2.0 ; gpl ; gplv2
3 ; gpl-2.0-or-later ; gpl ; gplv2 or later
3 ; gpl-3.0 ; gpl ; gpl (?:version |v )?3(?: 0)?
3 ; gpl-2.0 ; gpl ; gpl (?:version |v )?2(?: 0)?
3 ; gpl ; gpl ; gnu gpl
4 ; gpl ; gpl ; gpl license
4 ; gpl ; licence ; general public licence
4 ; gpl ; licensed ; gpl licensed
3 ; gpl-2.0-classpath ; exception ; gpl (?:version )?2(?: 0)? with (?:the )?classpath exception
2 ; gpl-2.0-classpath ; spdx ; spdx license identifier gpl 2 0(?: only)? with classpath exception 2 0
1 ; lgpl-3.0-or-later ; license ; gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version
1 ; lgpl-2.1-or-later ; license ; gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version
1 ; lgpl-2.0-or-later ; license ; gnu library general public license as published by the free software foundation either version 2 of the license or at your option any later version
1 ; lgpl ; license ; you should have received a copy of the gnu (?:lesser|library) general public license along with this (?:library|program)
2 ; lgpl-3.0-or-later ; spdx ; spdx license identifier lgpl 3 0 or later
2 ; lgpl-3.0 ; spdx ; spdx license identifier lgpl 3 0(?: only)?
2 ; lgpl-2.1-or-later ; spdx ; spdx license identifier lgpl 2 1 or later
2 ; lgpl-2.1 ; spdx ; spdx license identifier lgpl 2 1(?: only)?
2 ; lgpl-2.0 ; spdx ; spdx license identifier lgpl 2 0(?: only)?
3 ; lgpl-3.0 ; license ; lesser general public license (?:version |v )?3(?: 0)?
3 ; lgpl-2.1 ; license ; lesser general public license (?:version |v )?2 1
3 ; lgpl-2.0 ; license ; library general public license (?:version |v )?2(?: 0)?
3 ; lgpl-3.0 ; gpl ; lgplv3
3 ; lgpl-2.1 ; gpl ; lgplv2 1
3 ; lgpl-3.0 ; gpl ; lgpl (?:version |v )?3(?: 0)?
3 ; lgpl-2.1 ; gpl ; lgpl (?:version |v )?2 1
4 ; lgpl ; license ; lesser general public license
4 ; lgpl ; license ; library general public license
4 ; lgpl ; gpl ; gnu lgpl
4 ; lgpl ; gpl ; lgpl license
1 ; agpl-3.0-or-later ; license ; gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version
1 ; agpl-3.0 ; license ; (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?affero general public license
2 ; agpl-3.0-or-later ; spdx ; spdx license identifier agpl 3 0 or later
2 ; agpl-3.0 ; spdx ; spdx license identifier agpl 3 0(?: only)?
3 ; agpl-3.0 ; license ; affero general public license (?:version |v )?3(?: 0)?
3 ; agpl-3.0 ; gpl ; agplv3
3 ; agpl-3.0 ; gpl ; agpl (?:version |v )?3(?: 0)?
4 ; agpl ; license ; affero general public license
4 ; agpl ; gpl ; gnu agpl
1 ; gfdl ; documentation ; permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
2 ; gfdl-1.3 ; spdx ; spdx license identifier gfdl 1 3(?: only| or later)?
2 ; gfdl-1.2 ; spdx ; spdx license identifier gfdl 1 2(?: only| or later)?
3 ; gfdl-1.3 ; documentation ; gnu free documentation license version 1 3
3 ; gfdl-1.2 ; documentation ; gnu free documentation license version 1 2
4 ; gfdl ; documentation ; gnu free documentation license
1 ; bsd-3-clause ; endorse ; neither the name of .{1,200}? nor the names of its contributors may be used to endorse or promote products derived from this software
1 ; bsd-2-clause ; redistribut ; redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
1 ; bsd ; redistribut ; redistribution and use in source and binary forms with or without modification are permitted
1 ; bsd-4-clause ; advertising ; all advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment
1 ; bsd ; license ; use of this source code is governed by a bsd style license
1 ; bsd ; license ; (?:released|licensed|distributed|available) under (?:the )?(?:terms of )?(?:the )?(?:new |simplified |modified |revised )?bsd license
2 ; bsd-3-clause ; spdx ; spdx license identifier bsd 3 clause
2 ; bsd-2-clause ; spdx ; spdx license identifier bsd 2 clause
2 ; bsd-4-clause ; spdx ; spdx license identifier bsd 4 clause
2 ; bsd-3-clause-clear ; spdx ; spdx license identifier bsd 3 clause clear
2 ; bsd-2-clause-patent ; spdx ; spdx license identifier bsd 2 clause patent
2 ; 0bsd ; spdx ; spdx license identifier 0bsd
3 ; bsd-3-clause ; bsd ; (?:bsd )?(?:3|three) clause bsd(?: license)?
3 ; bsd-2-clause ; bsd ; (?:bsd )?(?:2|two) clause bsd(?: license)?
3 ; bsd-4-clause ; bsd ; (?:4|four) clause bsd(?: license)?
3 ; bsd-3-clause ; bsd ; bsd 3 clause(?: license)?
3 ; bsd-2-clause ; bsd ; bsd 2 clause(?: license)?
3 ; bsd-3-clause ; bsd ; (?:new|modified|revised) bsd license
3 ; bsd-2-clause ; bsd ; (?:simplified bsd|freebsd) license
4 ; bsd ; bsd ; bsd licen[sc]e
4 ; bsd ; bsd ; bsd style license
4 ; bsd ; bsd ; bsd licensed
3 ; 0bsd ; bsd ; (?:zero clause bsd|bsd zero clause)(?: license)?
1 ; isc ; permission ; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies
2 ; isc ; spdx ; spdx license identifier isc
4 ; isc ; license ; isc license
1 ; hpnd ; permission ; permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted
2 ; hpnd ; spdx ; spdx license identifier hpnd
1 ; mpl-2.0 ; mozilla ; this source code form is subject to the terms of the mozilla public license v(?:ersion)? 2 0
1 ; mpl-2.0 ; mozilla ; if a copy of the mpl was not distributed with this file you can obtain one at http(?:s)? mozilla org mpl 2 0
1 ; mpl-1.1 ; mozilla ; the contents of this file are subject to the mozilla public license version 1 1
2 ; mpl-2.0 ; spdx ; spdx license identifier mpl 2 0
2 ; mpl-1.1 ; spdx ; spdx license identifier mpl 1 1
2 ; mpl-1.0 ; spdx ; spdx license identifier mpl 1 0
3 ; mpl-2.0 ; mozilla ; mozilla public licen[sc]e (?:version |v )?2(?: 0)?
3 ; mpl-1.1 ; mozilla ; mozilla public licen[sc]e (?:version |v )?1 1
3 ; mpl-1.0 ; mozilla ; mozilla public licen[sc]e (?:version |v )?1 0
4 ; mpl ; mozilla ; mozilla public licen[sc]e
1 ; epl-2.0 ; eclipse ; this program and the accompanying materials are made available under the terms of the eclipse public license (?:version |v )?2 0
1 ; epl-1.0 ; eclipse ; this program and the accompanying materials are made available under the terms of the eclipse public license (?:version |v )?1 0
2 ; epl-2.0 ; spdx ; spdx license identifier epl 2 0
2 ; epl-1.0 ; spdx ; spdx license identifier epl 1 0
3 ; epl-2.0 ; eclipse ; eclipse public license (?:version |v )?2(?: 0)?
3 ; epl-1.0 ; eclipse ; eclipse public license (?:version |v )?1(?: 0)?
4 ; epl ; eclipse ; eclipse public license
3 ; edl-1.0 ; eclipse ; eclipse distribution license (?:version |v )?1 0
4 ; edl ; eclipse ; eclipse distribution license
1 ; cddl-1.0 ; common ; subject to the terms of the common development and distribution license
2 ; cddl-1.0 ; spdx ; spdx license identifier cddl 1 0
2 ; cddl-1.1 ; spdx ; spdx license identifier cddl 1 1
3 ; cddl-1.1 ; common ; common development and distribution license (?:version |v )?1 1
3 ; cddl-1.0 ; common ; common development and distribution license (?:version |v )?1 0
4 ; cddl ; common ; common development and distribution license
3 ; cpl-1.0 ; common ; common public license (?:version |v )?1 0
4 ; cpl ; common ; common public license
2 ; cpl-1.0 ; spdx ; spdx license identifier cpl 1 0
3 ; ipl-1.0 ; license ; ibm public license (?:version |v )?1 0
3 ; cc-by-nc-nd ; cc ; (?:licensed under |released under )?(?:a )?cc by nc nd(?: [1-4] [05])?
3 ; cc-by-nc-sa ; cc ; (?:licensed under |released under )?(?:a )?cc by nc sa(?: [1-4] [05])?
3 ; cc-by-nc ; cc ; (?:licensed under |released under )?(?:a )?cc by nc(?: [1-4] [05])?
3 ; cc-by-nd ; cc ; (?:licensed under |released under )?(?:a )?cc by nd(?: [1-4] [05])?
3 ; cc-by-sa ; cc ; (?:licensed under |released under )?(?:a )?cc by sa(?: [1-4] [05])?
3 ; cc-by ; cc ; (?:licensed under |released under )?(?:a )?cc by(?: [1-4] [05])?
3 ; cc0-1.0 ; cc0 ; cc0(?: 1 0)?(?: universal)?
1 ; cc-by-nc-nd ; commons ; creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1-4] [05])?(?: international| unported| generic)?(?: public)?(?: license)?
1 ; cc-by-nc-sa ; commons ; creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: international| unported| generic)?(?: public)?(?: license)?
1 ; cc-by-nc ; commons ; creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported| generic)?(?: public)?(?: license)?
1 ; cc-by-nd ; commons ; creative commons attribution no ?deriv(?:ative)?s(?: [1-4] [05])?(?: international| unported| generic)?(?: public)?(?: license)?
1 ; cc-by-sa ; commons ; creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported| generic)?(?: public)?(?: license)?
1 ; cc-by ; commons ; creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)?(?: public)?(?: license)?
1 ; cc0-1.0 ; commons ; creative commons (?:cc0|zero)(?: 1 0)?(?: universal)?(?: public domain dedication)?
2 ; cc-by-4.0 ; spdx ; spdx license identifier cc by 4 0
2 ; cc-by-sa-4.0 ; spdx ; spdx license identifier cc by sa 4 0
2 ; cc-by-nc-4.0 ; spdx ; spdx license identifier cc by nc 4 0
2 ; cc0-1.0 ; spdx ; spdx license identifier cc0 1 0
3 ; cc-by ; creativecommons ; creativecommons org licenses by [1-4] [05]
3 ; cc-by-sa ; creativecommons ; creativecommons org licenses by sa [1-4] [05]
3 ; cc-by-nc ; creativecommons ; creativecommons org licenses by nc [1-4] [05]
3 ; cc-by-nd ; creativecommons ; creativecommons org licenses by nd [1-4] [05]
3 ; cc-by-nc-sa ; creativecommons ; creativecommons org licenses by nc sa [1-4] [05]
3 ; cc-by-nc-nd ; creativecommons ; creativecommons org licenses by nc nd [1-4] [05]
3 ; cc0-1.0 ; creativecommons ; creativecommons org publicdomain zero 1 0
4 ; cc ; commons ; creative commons licen[sc]e
4 ; cc ; commons ; creative commons
1 ; unlicense ; public domain ; this is free and unencumbered software released into the public domain
2 ; unlicense ; spdx ; spdx license identifier unlicense
4 ; unlicense ; unlicense ; (?:the )?unlicense
1 ; public-domain ; public domain ; (?:released|placed|dedicated) (?:in)?to the public domain
1 ; public-domain ; public domain ; (?:is|are) (?:placed )?in the public domain
4 ; public-domain ; public domain ; public domain dedication
1 ; wtfpl ; public license ; do what the fuck you want to public license
2 ; wtfpl ; spdx ; spdx license identifier wtfpl
4 ; wtfpl ; wtfpl ; wtfpl
1 ; zlib ; warranty ; this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software
1 ; zlib ; misrepresented ; the origin of this software must not be misrepresented you must not claim that you wrote the original software
2 ; zlib ; spdx ; spdx license identifier zlib
4 ; zlib ; zlib ; zlib(?: libpng)? license
4 ; libpng ; libpng ; libpng license
1 ; bsl-1.0 ; boost ; distributed under the boost software license version 1 0
1 ; bsl-1.0 ; permission ; permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
2 ; bsl-1.0 ; spdx ; spdx license identifier bsl 1 0
3 ; bsl-1.0 ; boost ; boost software license (?:version |v )?1 0
4 ; bsl ; boost ; boost software license
1 ; artistic-2.0 ; artistic ; (?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the )?artistic license (?:version )?2 0
2 ; artistic-2.0 ; spdx ; spdx license identifier artistic 2 0
3 ; artistic-2.0 ; artistic ; artistic license (?:version )?2(?: 0)?
3 ; artistic-1.0 ; artistic ; artistic license (?:version )?1(?: 0)?
4 ; artistic ; artistic ; artistic license
1 ; perl ; perl ; (?:you can|it under) (?:redistribute it and or modify it under )?the same terms as perl itself
1 ; psf-2.0 ; python ; python software foundation license(?: version 2)?
2 ; psf-2.0 ; spdx ; spdx license identifier (?:psf|python) 2 0
4 ; psf ; psf ; psf license
1 ; openssl ; openssl ; this product includes software developed by the openssl project
4 ; openssl ; openssl ; openssl license
1 ; php-3.01 ; php ; this source file is subject to version 3 01 of the php license
4 ; php ; php ; php license
1 ; ruby ; ruby ; (?:redistribute|distributed|modify) .{0,80}?under the same terms as ruby
4 ; ruby ; ruby ; ruby license
1 ; ofl-1.1 ; font ; this font software is licensed under the sil open font license version 1 1
2 ; ofl-1.1 ; spdx ; spdx license identifier ofl 1 1
3 ; ofl-1.1 ; font ; sil open font license (?:version |v )?1 1
4 ; ofl ; font ; (?:sil )?open font license
1 ; ncsa ; illinois ; university of illinois ncsa open source license
2 ; ncsa ; spdx ; spdx license identifier ncsa
1 ; eupl-1.2 ; eupl ; licensed under the eupl(?: version)? 1 2
2 ; eupl-1.2 ; spdx ; spdx license identifier eupl 1 2
2 ; eupl-1.1 ; spdx ; spdx license identifier eupl 1 1
4 ; eupl ; european ; european union public licen[sc]e
3 ; ms-pl ; microsoft ; microsoft public license(?: ms pl)?
3 ; ms-rl ; microsoft ; microsoft reciprocal license(?: ms rl)?
2 ; ms-pl ; spdx ; spdx license identifier ms pl
3 ; odbl-1.0 ; database ; open (?:data commons )?(?:open )?database license(?: odbl)?(?: (?:version |v )?1 0)?
3 ; odc-by-1.0 ; attribution ; open data commons attribution license(?: (?:version |v )?1 0)?
3 ; pddl-1.0 ; public domain ; open data commons public domain dedication and licen[sc]e
1 ; odbl-1.0 ; database ; this database is made available under the open database license
3 ; afl-3.0 ; academic ; academic free license (?:version |v )?3 0
4 ; afl ; academic ; academic free license
3 ; osl-3.0 ; open software ; open software license (?:version |v )?3 0
4 ; osl ; open software ; open software license
3 ; qpl-1.0 ; public license ; q public license(?: version 1 0)?
3 ; sleepycat ; sleepycat ; sleepycat license
3 ; postgresql ; postgresql ; postgresql license
2 ; postgresql ; spdx ; spdx license identifier postgresql
1 ; unicode ; unicode ; unicode (?:license agreement|inc license agreement) data files and software
2 ; unicode-3.0 ; spdx ; spdx license identifier unicode 3 0
3 ; w3c ; w3c ; w3c software (?:notice and|and document) license
1 ; json ; evil ; the software shall be used for good not evil
1 ; beerware ; whatever ; as long as you retain this notice you can do whatever you want with this stuff
4 ; beerware ; beerware ; beerware license
1 ; curl ; curl ; curl license
1 ; imagemagick ; imagemagick ; imagemagick license
3 ; ecl-2.0 ; educational ; educational community license (?:version |v )?2 0
3 ; upl-1.0 ; universal ; universal permissive license(?: upl)?(?: (?:version |v )?1 0)?
2 ; upl-1.0 ; spdx ; spdx license identifier upl 1 0
3 ; mulan-psl-2.0 ; mulan ; mulan permissive software license (?:version |v )?2
3 ; cecill-2.1 ; cecill ; cecill(?: free software license)?(?: agreement)?(?: version)? 2 1
4 ; cecill ; cecill ; cecill
1 ; busl-1.1 ; business ; business source license (?:version |v )?1 1
4 ; busl ; business ; business source license
1 ; sspl-1.0 ; server ; server side public license(?: (?:version |v )?1)?
3 ; elastic-2.0 ; elastic ; elastic license (?:version |v )?2(?: 0)?
4 ; elastic ; elastic ; elastic license
3 ; polyform ; polyform ; polyform (?:noncommercial|small business|shield|strict) license(?: 1 0 0)?
1 ; commons-clause ; commons ; commons clause license condition(?: v1 0)?
3 ; vsl-1.0 ; vovida ; vovida software license
3 ; zpl-2.1 ; zope ; zope public license(?: (?:version |v )?2 1)?
3 ; tcl ; tcl ; tcl tk license
3 ; blueoak-1.0.0 ; blue oak ; blue oak model license(?: 1 0 0)?
1 ; proprietary ; reserved ; all rights reserved
1 ; proprietary ; confidential ; (?:proprietary and confidential|confidential and proprietary)
1 ; proprietary ; prohibited ; unauthorized copying of this file via any medium is strictly prohibited
1 ; non-commercial ; commercial ; for non ?commercial (?:use|purposes) only
1 ; non-commercial ; research ; for research (?:use|purposes) only
1 ; non-commercial ; academic ; for academic (?:use|purposes) only
1 ; non-commercial ; educational ; for educational (?:use|purposes) only
1 ; no-derivatives ; derivative ; no derivative works (?:are )?(?:allowed|permitted)
4 ; copyright ; copyright ; copyright (?:c )?(?:19|20)[0-9]{2}
"""

#: Words of which a text must hold at least one (as part of a word) before any signature is tried.
STEMS = (
    "licen", "spdx", "gpl", "copyright", "permission", "copies", "warrant", "redistribut", "advertising", "domain",
    "commons", "cc by", "cc0", "bsd", "wtfpl", "misrepresented", "eupl", "evil", "whatever", "perl", "ruby",
    "openssl", "cecill", "ncsa", "mozilla", "reserved", "confidential", "prohibited", "derivative",
    "commercial", "research", "academic", "educational", "free software", "documentation", "w3c", "odbl", "attribution", "endorse",
)
