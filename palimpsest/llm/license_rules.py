"""Signature rules of the license scan, written by hand. A heading names the keyword without which no rule under it is tried.

A line is: rank, label, regex over lower-case words with single spaces between them. Rank 0 is an identifier
tag, 1 a sentence of a license's body or its grant, 2 an address, 3 a name with its version or variant, 4 a name alone. No rule
is a single word that prose may have.
"""

TEXT = r"""
[spdx]
0 apache-2.0 spdx license identifier apache 2 0
0 mit-0 spdx license identifier mit 0
0 mit spdx license identifier mit
0 bsd-2-clause spdx license identifier bsd 2 clause
0 bsd-3-clause spdx license identifier bsd 3 clause
0 bsd-4-clause spdx license identifier bsd 4 clause
0 0bsd spdx license identifier 0bsd
0 agpl-3.0 spdx license identifier agpl 3 0(?: only| or later)?
0 lgpl-2.0 spdx license identifier lgpl 2 0(?: only| or later)?
0 lgpl-2.1 spdx license identifier lgpl 2 1(?: only| or later)?
0 lgpl-3.0 spdx license identifier lgpl 3 0(?: only| or later)?
0 gpl-2.0 spdx license identifier gpl 2 0(?: only| or later)?(?: with [a-z]+ exception(?: 2 0)?)?
0 gpl-3.0 spdx license identifier gpl 3 0(?: only| or later)?(?: with [a-z]+ exception(?: 3 1)?)?
0 mpl-2.0 spdx license identifier mpl 2 0(?: no copyleft exception)?
0 epl-2.0 spdx license identifier epl 2 0
0 epl-1.0 spdx license identifier epl 1 0
0 isc spdx license identifier isc
0 zlib spdx license identifier zlib
0 boost-1.0 spdx license identifier bsl 1 0
0 unlicense spdx license identifier unlicense
0 wtfpl spdx license identifier wtfpl
0 cc0-1.0 spdx license identifier cc0 1 0
0 cc-by-4.0 spdx license identifier cc by 4 0
0 cc-by-sa-4.0 spdx license identifier cc by sa 4 0
0 cc-by-nc-4.0 spdx license identifier cc by nc 4 0
0 ofl-1.1 spdx license identifier ofl 1 1
0 eupl-1.2 spdx license identifier eupl 1 2
0 cddl-1.0 spdx license identifier cddl 1 0
0 python-2.0 spdx license identifier (?:python|psf) 2 0
0 artistic-2.0 spdx license identifier artistic 2 0
0 postgresql spdx license identifier postgresql
0 ncsa spdx license identifier ncsa
0 mulan-2.0 spdx license identifier mulanpsl 2 0
[associated]
1 mit permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files(?: the software)? to deal in the software without restriction
1 mit permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation
1 ncsa of this software and associated documentation files the software to deal with the software without restriction
1 ncsa permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files(?: the software)? to deal with the software without restriction
[substantial]
1 mit the above copyright notice and this permission notice (?:\(including the next paragraph\) )?(?:including the next paragraph )?shall be included in all copies or substantial portions of the software
[furnished]
1 mit to permit persons to whom the software is furnished to do so subject to the following conditions
1 mit-0 to permit persons to whom the software is furnished to do so the software is provided as is
[sublicensable]
1 cc-by-4.0 grants you a worldwide royalty free non sublicensable non exclusive irrevocable license to exercise the licensed rights
[purpose]
1 isc permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies
1 0bsd permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided
1 hpnd permission to use copy modify and distribute this software and its documentation for any purpose(?: and)?(?: with or)? without fee is hereby granted
1 postgresql permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
1 zlib permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely
1 unlicense in source code form or as a compiled binary for any purpose commercial or non commercial and by any means
1 libpng permission is hereby granted to use copy modify and distribute this source code or portions hereof for any purpose without fee
[misrepresented]
1 zlib the origin of this software must not be misrepresented you must not claim that you wrote the original software
1 libpng the origin of this source code must not be misrepresented
[redistribution]
1 bsd redistribution and use in source and binary forms with or without modification are permitted(?: for any purpose)? provided that(?: the following conditions are met)?
1 bsd redistribution and use in source and binary forms with or without modification are permitted subject to the limitations in the disclaimer below
1 openssl redistribution and use in source and binary forms of the openssl toolkit
[redistributions]
1 bsd redistributions of source code must retain the above copyright notice
1 bsd-2-clause redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution this software is provided
1 bsd redistributions in binary form must reproduce the above copyright notice
1 openssl redistributions of any form whatsoever must retain the following acknowledgment
[endorse]
1 bsd-3-clause neither the names? of (?:\S+ ){1,12}nor the names of (?:its|their|any) contributors may be used to endorse or promote products derived from this software
1 bsd-3-clause the names? of (?:\S+ ){1,8}may not be used to endorse or promote products derived from this software without specific prior written permission
1 apache-1.1 the names apache (?:\S+ ){1,6}must not be used to endorse or promote products derived from this software
1 openssl the names openssl toolkit and openssl project must not be used to endorse or promote products
[advertising]
1 bsd-4-clause all advertising materials mentioning features or use of this software must display the following acknowledge?ment
1 x11 shall not be used in advertising or otherwise to promote the sale use or other dealings in this software without prior written authorization
1 hpnd not be used in advertising or publicity pertaining to distribution of the software without specific written prior permission
[apache]
1 apache-2.0 licensed under the apache license version 2 0(?: the)? license you may not use this (?:file|work|project) except in compliance with the license
1 apache-2.0 (?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?apache(?: software)? licen[cs]e(?: version| v)? 2(?: 0)?
1 apache-2.0 licensed to the apache software foundation asf under one or more contributor license agreements
1 apache-1.1 products derived from this software may not be called apache nor may apache appear in their name
1 apache-2.0 apache license version 2 0 january 2004
2 apache-2.0 (?:www )?apache org licenses license 2 0(?: txt| html)?
2 apache-1.1 (?:www )?apache org licenses license 1 1(?: txt)?
2 apache-1.0 (?:www )?apache org licenses license 1 0(?: txt)?
2 apache (?:www )?apache org licenses
3 apache-2.0 (?:the )?apache(?: software)? (?:licen[cs]e )?(?:version |v )?2(?: 0)?(?: licen[cs]e)
3 apache-2.0 (?:the )?apache(?: software)? licen[cs]e(?: version| v)? 2(?: 0)?
3 apache-2.0 (?:the )?apache(?: software)? licen[cs]e v2(?: 0)?
3 apache-1.1 (?:the )?apache(?: software)? licen[cs]e(?: version| v)? 1 1
3 apache-1.0 (?:the )?apache(?: software)? licen[cs]e(?: version| v)? 1 0
4 apache (?:the )?apache(?: software)? licen[cs]e
[asl]
4 apache-2.0 (?:under|use|license|licence) (?:the )?asl 2 0
[compliance]
1 apache-2.0 you may not use this (?:file|work|project) except in compliance with the license you may obtain a copy of the license at
[basis]
1 apache-2.0 software distributed under the license is distributed on an as is basis without warranties or conditions of any kind
1 mpl-1.1 software distributed under the license is distributed on an as is basis without warranty of any kind either express or implied see the license for the specific language
[contributor]
1 apache-2.0 each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|except)
1 mpl-2.0 each contributor hereby grants you a world wide royalty free non exclusive license
1 epl-1.0 each contributor hereby grants recipient a non exclusive worldwide royalty free copyright license
[mit]
1 mit (?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms (?:and conditions )?of )?(?:the |an )?mit(?: x11)? licen[cs]e
2 mit opensource org licenses mit(?: license)?(?: php| html)?
2 mit choosealicense com licenses mit
2 mit mit license org
3 mit-0 (?:the )?mit no attribution(?: licen[cs]e)?
3 mit-0 (?:the )?mit 0 licen[cs]e
3 x11 (?:the )?mit x11 licen[cs]e
4 mit (?:the )?mit(?: expat| open source| style)? licen[cs]e
4 mit licen[cs]e(?: type)? mit licen[cs]e
[expat]
4 mit (?:the )?expat licen[cs]e
[x11]
4 x11 (?:the )?x11 licen[cs]e
[gnu]
1 agpl-3.0 you can redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e(?: as published by the free software foundation)?(?: either)?(?: version 3)?
1 lgpl-2.1 you can redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e as published by the free software foundation either version 2 1
1 lgpl-3.0 you can redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e as published by the free software foundation either version 3
1 lgpl-2.0 you can redistribute it and or modify it under the terms of the gnu library general public licen[cs]e
1 gpl-3.0 you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e(?: as published by the free software foundation)?(?: either)? version 3
1 gpl-2.0 you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e(?: as published by the free software foundation)?(?: either)? version 2
1 gpl you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e
1 gfdl permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e
1 gpl-3.0 (?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the )?gnu general public licen[cs]e(?: version| v)? 3(?: 0)?
1 gpl-2.0 (?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the )?gnu general public licen[cs]e(?: version| v)? 2(?: 0)?
1 gpl you should have received a copy of the gnu general public licen[cs]e along with this program
1 lgpl you should have received a copy of the gnu lesser general public licen[cs]e along with this (?:library|program)
1 agpl-3.0 you should have received a copy of the gnu affero general public licen[cs]e along with this program
1 gpl-2.0 gnu general public licen[cs]e version 2 june 1991
1 gpl-3.0 gnu general public licen[cs]e version 3 29 june 2007
1 lgpl-2.1 gnu lesser general public licen[cs]e version 2 1 february 1999
1 lgpl-3.0 gnu lesser general public licen[cs]e version 3 29 june 2007
1 agpl-3.0 gnu affero general public licen[cs]e version 3 19 november 2007
2 gpl-1.0 (?:www )?gnu org licenses (?:old licenses )?gpl 1 0(?: txt| html)?
2 gpl-2.0 (?:www )?gnu org licenses (?:old licenses )?gpl 2 0(?: txt| html)?
2 gpl-3.0 (?:www )?gnu org licenses gpl 3 0(?: txt| html)?
2 lgpl-2.1 (?:www )?gnu org licenses (?:old licenses )?lgpl 2 1(?: txt| html)?
2 lgpl-3.0 (?:www )?gnu org licenses lgpl 3 0(?: txt| html)?
2 agpl-3.0 (?:www )?gnu org licenses agpl 3 0(?: txt| html)?
2 gfdl (?:www )?gnu org (?:licenses|copyleft) fdl(?: 1 [123])?(?: txt| html)?
2 gpl (?:www )?gnu org (?:licenses|copyleft) gpl(?: txt| html)?
2 lgpl (?:www )?gnu org (?:licenses|copyleft) lgpl(?: txt| html)?
3 agpl-3.0 (?:the )?gnu affero general public licen[cs]e(?: version| v)? 3(?: 0)?
3 lgpl-2.0 (?:the )?gnu library general public licen[cs]e(?: version| v)? 2(?: 0)?
3 lgpl-2.1 (?:the )?gnu lesser general public licen[cs]e(?: version| v)? 2 1
3 lgpl-3.0 (?:the )?gnu lesser general public licen[cs]e(?: version| v)? 3(?: 0)?
3 gpl-1.0 (?:the )?gnu general public licen[cs]e(?: version| v)? 1(?: 0)?
3 gpl-2.0 (?:the )?gnu general public licen[cs]e(?: version| v)? ?2(?: 0)?
3 gpl-3.0 (?:the )?gnu general public licen[cs]e(?: version| v)? ?3(?: 0)?
3 gpl-2.0 (?:the )?gnu gpl ?(?:version |v ?)?2(?: 0)?
3 gpl-3.0 (?:the )?gnu gpl ?(?:version |v ?)?3(?: 0)?
3 gfdl (?:the )?gnu free documentation licen[cs]e(?: version| v)? 1 [123]
4 gfdl (?:the )?gnu free documentation licen[cs]e
4 agpl (?:the )?gnu affero general public licen[cs]e
4 lgpl (?:the )?gnu (?:lesser|library) general public licen[cs]e
4 gpl (?:the )?gnu (?:general public licen[cs]e|gpl)
4 lgpl (?:the )?gnu lgpl
4 agpl (?:the )?gnu agpl
[gpl]
3 gpl-2.0 gpl ?(?:version |v ?)?2 0(?: only| or later)?
3 gpl-3.0 gpl ?(?:version |v ?)?3 0(?: only| or later)?
3 gpl-2.0 gpl (?:version |v ?)2(?: or later)?
3 gpl-3.0 gpl (?:version |v ?)3(?: or later)?
4 gpl (?:under|licensed) (?:the )?(?:terms of the )?gpl(?: licen[cs]e)?
[gplv2]
3 gpl-2.0 (?:under|license|licence|licensed|the) gplv2
[gplv3]
3 gpl-3.0 (?:under|license|licence|licensed|the) gplv3
[lgpl]
3 lgpl-2.1 lgpl ?(?:version |v ?)?2 1(?: only| or later)?
3 lgpl-3.0 lgpl ?(?:version |v ?)?3(?: 0)(?: only| or later)?
4 lgpl (?:under|licensed) (?:the )?(?:terms of the )?lgpl(?: licen[cs]e)?
[agpl]
3 agpl-3.0 agpl ?(?:version |v ?)?3(?: 0)?(?: only| or later)?
4 agpl (?:under|licensed) (?:the )?(?:terms of the )?agpl(?: licen[cs]e)?
[affero]
4 agpl (?:the )?affero general public licen[cs]e
[freedom]
1 gpl the licenses for most software(?: and other practical works)? are designed to take away your freedom to share and change
[useful]
1 gpl this program is distributed in the hope that it will be useful but without any warranty
1 lgpl this library is distributed in the hope that it will be useful but without any warranty
[cc]
2 cc-by-4.0 cc by 4 0 international
3 cc-by-nc-sa-4.0 cc by nc sa 4 0
3 cc-by-nc-nd-4.0 cc by nc nd 4 0
3 cc-by-nc-sa-3.0 cc by nc sa 3 0
3 cc-by-nc-nd-3.0 cc by nc nd 3 0
3 cc-by-nc-4.0 cc by nc 4 0
3 cc-by-nc-3.0 cc by nc 3 0
3 cc-by-sa-4.0 cc by sa 4 0
3 cc-by-sa-3.0 cc by sa 3 0
3 cc-by-sa-2.5 cc by sa 2 5
3 cc-by-nd-4.0 cc by nd 4 0
3 cc-by-nd-3.0 cc by nd 3 0
3 cc-by-4.0 cc by 4 0
3 cc-by-3.0 cc by 3 0
3 cc-by-2.0 cc by 2 [05]
4 cc-by-nc-sa cc by nc sa
4 cc-by-nc-nd cc by nc nd
4 cc-by-nc cc by nc
4 cc-by-sa cc by sa
4 cc-by-nd cc by nd
4 cc-by cc by licen[cs]e
[creativecommons]
2 cc-by-nc-sa-4.0 creativecommons org licenses by nc sa 4 0
2 cc-by-nc-nd-4.0 creativecommons org licenses by nc nd 4 0
2 cc-by-nc-sa creativecommons org licenses by nc sa
2 cc-by-nc-nd creativecommons org licenses by nc nd
2 cc-by-nc-4.0 creativecommons org licenses by nc 4 0
2 cc-by-nc creativecommons org licenses by nc
2 cc-by-sa-4.0 creativecommons org licenses by sa 4 0
2 cc-by-sa-3.0 creativecommons org licenses by sa 3 0
2 cc-by-sa creativecommons org licenses by sa
2 cc-by-nd-4.0 creativecommons org licenses by nd 4 0
2 cc-by-nd creativecommons org licenses by nd
2 cc-by-4.0 creativecommons org licenses by 4 0
2 cc-by-3.0 creativecommons org licenses by 3 0
2 cc-by creativecommons org licenses by
2 cc0-1.0 creativecommons org publicdomain zero(?: 1 0)?
2 public-domain creativecommons org publicdomain mark
[commons]
3 cc-by-nc-sa (?:the |a )?creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?
3 cc-by-nc-nd (?:the |a )?creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?
3 cc-by-nc (?:the |a )?creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?
3 cc-by-sa (?:the |a )?creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?
3 cc-by-nd (?:the |a )?creative commons attribution no ?deriv(?:ative)?s(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?
3 cc-by-4.0 (?:the |a )?creative commons attribution 4 0(?: international)?(?: public)?(?: licen[cs]e)?
3 cc-by-3.0 (?:the |a )?creative commons attribution 3 0(?: unported)?(?: licen[cs]e)?
3 cc0-1.0 creative commons (?:cc0|zero)(?: 1 0)?(?: universal)?
4 cc-by (?:the |a )?creative commons attribution licen[cs]e
4 creative-commons (?:the |a )?creative commons licen[cs]e
[cc0]
3 cc0-1.0 cc0 1 0(?: universal)?(?: public domain dedication)?
4 cc0-1.0 (?:under|licensed|released|waived|via) (?:the )?cc0(?: licen[cs]e| waiver)?
[overtly]
1 cc0-1.0 affirmer hereby overtly fully permanently irrevocably and unconditionally waives abandons and surrenders
[bsd]
1 bsd (?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the |a )?bsd(?: style)? licen[cs]e
2 bsd-2-clause opensource org licenses bsd 2 clause
2 bsd-3-clause opensource org licenses bsd 3 clause
2 bsd opensource org licenses bsd license(?: php)?
3 bsd-2-clause (?:the )?(?:simplified|freebsd|2 clause|two clause) bsd(?: licen[cs]e)
3 bsd-2-clause bsd (?:2|two) clause(?: licen[cs]e)?
3 bsd-3-clause (?:the )?(?:new|modified|revised|3 clause|three clause) bsd(?: licen[cs]e)
3 bsd-3-clause bsd (?:3|three) clause(?: licen[cs]e)?
3 bsd-4-clause (?:the )?(?:original|old|4 clause|four clause) bsd(?: licen[cs]e)
3 bsd-4-clause bsd (?:4|four) clause(?: licen[cs]e)?
3 0bsd (?:the )?(?:zero clause|0 clause|free public) bsd(?: licen[cs]e)
4 bsd (?:the )?bsd(?: style| like)? licen[cs]e
[0bsd]
4 0bsd (?:the )?0bsd licen[cs]e
[isc]
2 isc opensource org licenses isc(?: license)?
4 isc (?:the )?isc licen[cs]e
[mozilla]
1 mpl-2.0 this source code form is subject to the terms of the mozilla public licen[cs]e v(?:ersion)? 2 0
1 mpl-1.1 the contents of this file are subject to the mozilla public licen[cs]e version 1 1
1 mpl-2.0 if a copy of the mpl was not distributed with this file you can obtain one at (?:https? )?(?:www )?mozilla org mpl 2 0
2 mpl-2.0 (?:www )?mozilla org (?:en us )?mpl 2 0
2 mpl-1.1 (?:www )?mozilla org mpl mpl 1 1
2 mpl (?:www )?mozilla org (?:en us )?mpl
3 mpl-1.1 (?:the )?mozilla public licen[cs]e(?: version| v)? 1 1
3 mpl-1.0 (?:the )?mozilla public licen[cs]e(?: version| v)? 1 0
3 mpl-2.0 (?:the )?mozilla public licen[cs]e(?: version| v)? 2(?: 0)?
4 mpl (?:the )?mozilla public licen[cs]e
[mpl]
3 mpl-2.0 mpl (?:version |v ?)?2 0
3 mpl-1.1 mpl (?:version |v ?)?1 1
[eclipse]
1 epl-1.0 this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e v(?:ersion)? ?1 0
1 epl-2.0 this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e v? ?2 0
1 epl-2.0 made available under the terms of the eclipse public licen[cs]e v(?:ersion)? 2 0
2 epl-1.0 (?:www )?eclipse org legal epl v10(?: html)?
2 epl-2.0 (?:www )?eclipse org legal epl (?:v20|2 0)(?: html)?
2 edl-1.0 (?:www )?eclipse org org documents edl v10(?: php| html)?
3 epl-1.0 (?:the )?eclipse public licen[cs]e(?: version| v)? 1(?: 0)?
3 epl-2.0 (?:the )?eclipse public licen[cs]e(?: version| v)? 2(?: 0)?
4 epl (?:the )?eclipse public licen[cs]e
4 edl-1.0 (?:the )?eclipse distribution licen[cs]e
[cddl]
3 cddl-1.0 cddl (?:version |v ?)?1 0
3 cddl-1.1 cddl (?:version |v ?)?1 1
4 cddl (?:the |under )cddl(?: licen[cs]e)?
[distribution]
3 cddl-1.0 common development and distribution licen[cs]e(?: cddl)?(?: version| v)? 1 0
3 cddl-1.1 common development and distribution licen[cs]e(?: cddl)?(?: version| v)? 1 1
4 cddl common development and distribution licen[cs]e
[ibm]
3 ipl-1.0 ibm public licen[cs]e(?: version| v)? 1 0
[artistic]
3 artistic-2.0 (?:the )?artistic licen[cs]e(?: version| v)? 2(?: 0)?
3 artistic-1.0 (?:the )?artistic licen[cs]e(?: version| v)? 1(?: 0)?
4 artistic (?:the )?artistic licen[cs]e
[perl]
1 artistic-1.0 (?:redistribute it and or modify it )?under the same terms as perl(?: 5)?(?: itself)?
[zlib]
2 zlib (?:opensource org licenses|www zlib net|zlib net) zlib(?: license)?
4 zlib (?:the )?zlib(?: libpng)? licen[cs]e
[libpng]
4 libpng (?:the )?libpng licen[cs]e
[boost]
1 boost-1.0 distributed under the boost software licen[cs]e version 1 0
1 boost-1.0 boost software licen[cs]e version 1 0 august 17th 2003
2 boost-1.0 (?:www )?boost org (?:users )?licen[cs]e(?: 1 0)?(?: txt)?
3 boost-1.0 (?:the )?boost software licen[cs]e(?: version| v)? 1 0
4 boost-1.0 (?:the )?boost(?: software)? licen[cs]e
[unencumbered]
1 unlicense this is free and unencumbered software released into the public domain
[unlicense]
2 unlicense (?:www )?unlicense org
4 unlicense (?:under|license|licence|released) (?:the )?unlicense
[wtfpl]
2 wtfpl (?:www )?wtfpl net
3 wtfpl wtfpl (?:version |v ?)2
4 wtfpl (?:the |under )wtfpl(?: licen[cs]e)?
[fuck]
1 wtfpl do what the fuck you want to public licen[cs]e
[python]
1 python-2.0 python software foundation licen[cs]e(?: agreement)?(?: version| v)? 2(?: 0)?
4 python-2.0 (?:the )?python(?: software foundation)? licen[cs]e
[psf]
1 python-2.0 psf licen[cs]e agreement for python
4 python-2.0 (?:the )?psf licen[cs]e
[ruby]
4 ruby (?:the )?ruby licen[cs]e
4 ruby under the same terms as ruby(?: itself)?
[php]
2 php-3.01 (?:www )?php net licen[cs]e(?: 3 01)?(?: txt)?
3 php-3.01 (?:the )?php licen[cs]e(?: version| v)? 3 01
3 php-3.0 (?:the )?php licen[cs]e(?: version| v)? 3 0
4 php (?:the )?php licen[cs]e
[openssl]
2 openssl (?:www )?openssl org source licen[cs]e
4 openssl (?:the )?openssl licen[cs]e
[eupl]
1 eupl-1.2 licensed under the eupl(?: version| v)? 1 2
1 eupl-1.1 licensed under the eupl(?: version| v)? 1 1
3 eupl-1.2 eupl (?:version |v ?)?1 2
3 eupl-1.1 eupl (?:version |v ?)?1 1
4 eupl european union public licen[cs]e eupl
[european]
3 eupl-1.2 european union public licen[cs]e(?: version| v)? 1 2
4 eupl european union public licen[cs]e
[sil]
1 ofl-1.1 this font software is licensed under the sil open font licen[cs]e(?: version| v)? 1 1
2 ofl-1.1 scripts sil org ofl
3 ofl-1.1 (?:the )?sil open font licen[cs]e(?: version| v)? 1 1
4 ofl (?:the )?sil (?:open font licen[cs]e|ofl)
[font]
4 ofl (?:the )?open font licen[cs]e
[database]
3 odbl-1.0 (?:the )?open(?: data commons)? database licen[cs]e(?: odbl)?(?: version| v)? 1 0
4 odbl (?:the )?open database licen[cs]e
[opendatacommons]
2 odbl-1.0 opendatacommons org licenses odbl(?: 1 0)?
2 odc-by-1.0 opendatacommons org licenses by(?: 1 0)?
2 pddl-1.0 opendatacommons org licenses pddl(?: 1 0)?
[ncsa]
4 ncsa (?:university of illinois )?ncsa open source licen[cs]e
[postgresql]
4 postgresql (?:the )?postgresql licen[cs]e
[mulan]
3 mulan-2.0 mulan permissive software licen[cs]e(?: version| v)? ?2
4 mulan mulan (?:permissive software licen[cs]e|psl)
[elastic]
3 elastic-2.0 (?:the )?elastic licen[cs]e(?: version| v)? 2(?: 0)?
4 elastic (?:the )?elastic licen[cs]e
[business]
3 busl-1.1 (?:the )?business source licen[cs]e(?: version| v)? 1 1
4 busl (?:the )?business source licen[cs]e
[server]
3 sspl-1.0 (?:the )?server side public licen[cs]e(?: version| v)? 1
4 sspl (?:the )?server side public licen[cs]e
[cecill]
4 cecill (?:the )?cecill(?: [abc]| 2 1)? (?:free software )?licen[cs]e
[domain]
1 public-domain (?:hereby )?(?:dedicated|dedicate|released|release|placed|place) (?:this (?:work|software|file|code) )?(?:in|into|to) the public domain
3 public-domain public domain dedication
4 public-domain this (?:work|file|software|text|book) is in the public domain
[proprietary]
1 proprietary (?:this (?:software|document|file) is |contains )?(?:the )?confidential and proprietary (?:information|property) of
1 proprietary unauthori[sz]ed copying of this file via any medium is strictly prohibited(?: proprietary and confidential)?
[prohibited]
1 proprietary unauthori[sz]ed (?:copying|reproduction|distribution|use) (?:\S+ ){0,12}is strictly prohibited
"""
