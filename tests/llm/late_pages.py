"""Forty pages written by hand before the model was changed for them: short articles, other scripts, headers and footers inside articles,
hidden elements, layout tables, generators' markup.  PAGES: name to (page, blocks of its main text).  REPORTED are eight more, from a review.
"""

EN = ["The old mill at the edge of town has found a new owner after eleven years.", "She plans to grind flour there again from next spring on.", "Volunteers cleared the millpond over two weekends in October."]
DE = ["Die alte Mühle am Stadtrand hat nach elf Jahren eine neue Besitzerin gefunden.", "Ab dem nächsten Frühjahr soll dort wieder Mehl gemahlen werden.", "Freiwillige räumten im Oktober an zwei Wochenenden den Mühlteich frei."]
RU = ["Старая мельница на окраине города спустя одиннадцать лет нашла новую хозяйку.", "Со следующей весны там снова будут молоть муку.", "В октябре добровольцы за два выходных расчистили мельничный пруд."]
ZH = ["城边的老磨坊在闲置十一年之后，终于迎来了新的主人。", "她打算从明年春天起重新在这里磨面粉。", "十月里，志愿者用两个周末清理了磨坊的池塘。"]
JA = ["町外れの古い水車小屋に、十一年ぶりに新しい持ち主が決まった。", "来春からふたたび粉をひく計画だという。", "十月の週末には有志が池の掃除をした。"]
AR = ["وجدت الطاحونة القديمة على أطراف البلدة مالكة جديدة بعد أحد عشر عاما.", "وتنوي أن تطحن الدقيق هناك من جديد ابتداء من الربيع المقبل.", "وقد نظف المتطوعون بركة الطاحونة في شهر أكتوبر."]
TH = ["โรงสีเก่าชายเมืองได้เจ้าของใหม่หลังจากผ่านไปสิบเอ็ดปี", "เธอวางแผนจะโม่แป้งที่นั่นอีกครั้งตั้งแต่ฤดูใบไม้ผลิหน้า", "อาสาสมัครช่วยกันทำความสะอาดสระน้ำเมื่อเดือนตุลาคม"]
NAV = '<a href="/">Home</a> <a href="/news">News</a> <a href="/sport">Sport</a> <a href="/contact">Contact</a>'
UL = '<ul><li><a href="/a">Start</a></li><li><a href="/b">Archive</a></li><li><a href="/c">Contact</a></li></ul>'
T = "A mill changes hands"


def ps(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


PAGES = {
    "one sentence": (f"<html><body><nav>{UL}</nav><article><p>{EN[0]}</p></article><footer>Town Gazette</footer></body></html>", [EN[0]]),
    "title and one sentence": (f"<body><header><a href=/>Town Gazette</a></header><main><h1>{T}</h1><p>{EN[1]}</p></main><footer><p>&copy; 2021 Town Gazette</p></footer>", [T, EN[1]]),
    "header inside the article": (f"<body><nav>{UL}</nav><article><header><h1>{T}</h1></header>{ps(EN)}</article></body>", [T, *EN]),
    "header and footer inside the article": (f"<body><article><header><h2>{T}</h2></header>{ps(EN[:2])}<footer><a href=/t/mill>mill</a> <a href=/t/town>town</a></footer></article></body>", [T, *EN[:2]]),
    "short story with footer": (f"<article><h1>{T}</h1><p>{EN[1]}</p><footer>Tags: <a href=/x>mill</a></footer></article>", [T, EN[1]]),
    "hidden paragraph": (f"<article><h1>{T}</h1><p>{EN[0]}</p><p hidden>Draft, do not print.</p><p>{EN[1]}</p></article>", [T, *EN[:2]]),
    "display none": (f"<main><h1>{T}</h1><div style='display: none'><p>{EN[2]}</p></div>{ps(EN[:2])}</main>", [T, *EN[:2]]),
    "hidden menu": (f"<body><div hidden>{UL}</div><main>{ps(EN)}</main></body>", EN),
    "german names": (f'<body><div class="kopf">{NAV}</div><div class="inhalt"><h1>Neues Leben in der Mühle</h1>{ps(DE)}</div><div class="fuss">&copy; 2021 Stadtblatt</div></body>', ["Neues Leben in der Mühle", *DE]),
    "german short": (f'<body><div id="navi">{UL}</div><div id="text"><h2>Mühle</h2><p>{DE[1]}</p></div></body>', ["Mühle", DE[1]]),
    "german article": (f"<body><nav>{UL}</nav><article><h1>Mühle</h1>{ps(DE)}</article><footer>Impressum</footer></body>", ["Mühle", *DE]),
    "russian article": (f"<body><nav><ul><li><a href=/>Главная</a></li><li><a href=/n>Новости</a></li></ul></nav><article><h1>Мельница</h1>{ps(RU)}</article><footer>Все права защищены</footer></body>", ["Мельница", *RU]),
    "russian divisions": (f"<body><div><a href=/>Главная</a> | <a href=/n>Новости</a></div><div><h1>Мельница</h1>{ps(RU)}</div><div>&copy; 2021 Городская газета</div></body>", ["Мельница", *RU]),
    "chinese article": (f"<body><nav><ul><li><a href=/>首页</a></li><li><a href=/n>新闻</a></li></ul></nav><article><h1>老磨坊</h1>{ps(ZH)}</article><footer>版权所有</footer></body>", ["老磨坊", *ZH]),
    "chinese divisions": (f'<body><div class="nav"><a href=/>首页</a> <a href=/n>新闻</a></div><div class="content"><h1>老磨坊</h1>{ps(ZH)}</div><div class="footer">&copy; 2021 小城日报</div></body>', ["老磨坊", *ZH]),
    "chinese without names": (f"<body><div><a href=/>首页</a> <a href=/n>新闻</a> <a href=/s>体育</a></div><div><h1>老磨坊</h1>{ps(ZH)}</div><div>&copy; 2021 小城日报</div></body>", ["老磨坊", *ZH]),
    "japanese article": (f"<body><header><a href=/>町の新聞</a></header><main><h1>水車小屋</h1>{ps(JA)}</main></body>", ["水車小屋", *JA]),
    "arabic article": (f'<html dir=rtl><body><nav><a href=/>الرئيسية</a> <a href=/n>الأخبار</a></nav><article><h1>الطاحونة</h1>{ps(AR)}</article></body></html>', ["الطاحونة", *AR]),
    "thai article": (f"<body><nav><a href=/>หน้าแรก</a> <a href=/n>ข่าว</a></nav><article><h1>โรงสี</h1>{ps(TH)}</article><footer>สงวนลิขสิทธิ์</footer></body>", ["โรงสี", *TH]),
    "thai divisions": (f'<body><div id="menu"><a href=/>หน้าแรก</a> <a href=/n>ข่าว</a></div><div id="main">{ps(TH)}</div></body>', TH),
    "blog engine": (f'<body class="single post"><header id="masthead" class="site-header"><p class="site-title"><a href="/">Town notes</a></p></header><div id="content" class="site-content"><main id="main"><article class="post type-post hentry"><header class="entry-header"><h1 class="entry-title">{T}</h1></header><div class="entry-content">{ps(EN)}</div></article></main></div><aside id="secondary" class="widget-area"><section class="widget"><h2>Recent posts</h2>{UL}</section></aside><footer id="colophon" class="site-footer">Proudly made by hand</footer></body>', [T, *EN]),
    "documentation": (f'<body><div class="sphinxsidebar"><h3>Contents</h3>{UL}</div><div class="document"><div class="body" role="main"><section id="mill"><h1>{T}</h1>{ps(EN)}<pre>grind --fine</pre></section></div></div><div class="footer">&copy; Copyright 2021, millers.</div></body>', [T, *EN, "grind --fine"]),
    "wiki": (f'<body><div id="content" class="mw-body" role="main"><h1 id="firstHeading">{T}</h1><div id="bodyContent"><div id="mw-content-text">{ps(EN)}<h2>Pond</h2><p>{EN[2]}</p></div></div></div><div id="mw-navigation"><div id="p-navigation" role="navigation">{UL}</div></div><div id="footer" role="contentinfo"><ul><li>Last edited in May.</li></ul></div></body>', [T, *EN, "Pond", EN[2]]),
    "forum thread": (f'<body><nav>{UL}</nav><main><h1>{T}</h1><div class="post"><p>{EN[0]}</p><p>{EN[2]}</p></div></main><footer>Board rules</footer></body>', [T, EN[0], EN[2]]),
    "press release": (f'<body><div id="top"><img src=logo.png alt=Logo></div><div id="release"><h1>{T}</h1><p><strong>Millford, 3 May.</strong> {EN[0]}</p>{ps(EN[1:])}<p>{EN[0]}</p></div></body>', [T, "Millford, 3 May. " + EN[0], *EN[1:], EN[0]]),
    "layout table with rows": (f"<body><table><tr><td colspan=2>{NAV}</td></tr><tr><td>{UL}</td><td><h1>{T}</h1>{ps(EN)}</td></tr><tr><td colspan=2>Copyright 2020 Town Gazette</td></tr></table></body>", [T, *EN]),
    "layout table with fonts": (f"<center><table border=0><tr><td><font size=2>{NAV}</font></td></tr><tr><td><font size=5>{T}</font><p><font>{EN[0]} {EN[1]}</font></p><p><font>{EN[2]} {EN[0]}</font></p></td></tr></table></center>", [T, f"{EN[0]} {EN[1]}", f"{EN[2]} {EN[0]}"]),
    "cookie window first": (f'<body><div class="cc-window cc-banner" role="dialog"><span>This website uses cookies to ensure you get the best experience.</span><a class="cc-btn">Got it!</a></div><div class="text"><h1>{T}</h1>{ps(EN)}</div></body>', [T, *EN]),
    "consent dialog last": (f'<body><main><h1>{T}</h1>{ps(EN)}</main><dialog open class="consent"><p>We and our partners store cookies on your device.</p></dialog></body>', [T, *EN]),
    "newsletter box within": (f'<body><article><h1>{T}</h1><p>{EN[0]}</p><div class="newsletter-signup"><h3>Stay informed</h3><p>Subscribe to our newsletter.</p></div>{ps(EN[1:])}</article></body>', [T, *EN]),
    "share buttons": (f'<body><article><h1>{T}</h1><ul class="share-buttons"><li><a href=/f>Facebook</a></li><li><a href=/t>Twitter</a></li></ul>{ps(EN)}</article></body>', [T, *EN]),
    "breadcrumbs": (f'<body><ol class="breadcrumb"><li><a href=/>Home</a></li><li><a href=/n>News</a></li><li>Mills</li></ol><article><h1>{T}</h1>{ps(EN)}</article></body>', [T, *EN]),
    "pagination": (f'<body><article><h1>{T}</h1>{ps(EN)}</article><div class="pagination"><a href=?p=1>1</a> <a href=?p=2>2</a> <a href=?p=3>Next</a></div></body>', [T, *EN]),
    "recipe": (f"<body><nav>{UL}</nav><article><h1>Mill bread</h1><p>{EN[1]}</p><h2>Ingredients</h2><ul><li>500 g flour</li><li>Water</li></ul><h2>Steps</h2><ol><li>Mix it all.</li><li>Bake for an hour.</li></ol></article></body>", ["Mill bread", EN[1], "Ingredients", "500 g flour", "Water", "Steps", "Mix it all.", "Bake for an hour."]),
    "interview": (f"<main><h1>{T}</h1><p><b>Why a mill?</b></p><p>{EN[1]}</p><p><b>And the pond?</b></p><p>{EN[2]}</p></main>", [T, "Why a mill?", EN[1], "And the pond?", EN[2]]),
    "definition list": (f"<article><h1>Words of the mill</h1><dl><dt>Hopper</dt><dd>It holds the grain above the stones.</dd><dt>Race</dt><dd>It leads the water to the wheel.</dd></dl></article>", ["Words of the mill", "Hopper", "It holds the grain above the stones.", "Race", "It leads the water to the wheel."]),
    "poem": ("<article><h1>Mill song</h1><p>Turn, wheel, turn,<br>the river is high,<br>the stones are cold</p><p>and the flour is dry.</p></article>", ["Mill song", "Turn, wheel, turn, the river is high, the stones are cold", "and the flour is dry."]),
    "sections in main": (f"<body><header><h1>Town Gazette</h1></header><main><section><h2>{T}</h2><p>{EN[0]}</p></section><section><h2>Water</h2><p>{EN[2]}</p></section></main><footer>{UL}</footer></body>", [T, EN[0], "Water", EN[2]]),
    "comments below": (f'<body><article><h1>{T}</h1>{ps(EN)}</article><section id="comments"><h2>2 comments</h2><article class="comment"><p>Great news for the town, at last.</p></article><article class="comment"><p>My grandfather worked there.</p></article></section></body>', [T, *EN]),
    "search page": (f'<body><form role="search"><input type=search><p>Type a word.</p></form><nav>{UL}</nav><footer><p>Town Gazette, Mill Street 1</p></footer></body>', []),
}

ONE = "A single paragraph of the story, some seventy characters in it."
REPORTED = {
    "own header, byline and footer": (f"<article><header><h1>Real title</h1><p class=byline>By Joe</p></header><p>{ONE}</p><footer><p>Filed under: dogs</p></footer></article>", ["Real title", ONE]),
    "hidden elements in a short article": ("<article><p>One sentence stands here.</p><p hidden>secret</p><div style='display:none'>more secret</div></article>", ["One sentence stands here."]),
    "story in a row of its own": (f"<table><tr><td><a href=/>Home</a></td></tr><tr><td><b>A title</b><br>{EN[0]} {EN[1]}</td></tr></table>", [f"A title {EN[0]} {EN[1]}"]),
    "division with two paragraphs": (f"<div><h2>{T}</h2><p>{EN[0]}</p><p>{EN[1]}</p></div>", [T, EN[0], EN[1]]),
    "inhalt": (f"<div class=inhalt><h1>Mühle</h1><p>{DE[0]} {DE[1]}</p><p>Kurz.</p></div>", ["Mühle", f"{DE[0]} {DE[1]}", "Kurz."]),
    "chinese": (f"<html><body><div><h1>老磨坊</h1>{ps(ZH)}</div></body></html>", ["老磨坊", *ZH]),
    "cookie notice of cc-window": (f'<div class="cc-window">This website uses cookies.</div><div>{EN[0]} {EN[1]} {EN[2]}</div>', [" ".join(EN)]),
    "copyright in a layout table": (f"<table><tr><td>{NAV}</td></tr><tr><td><p>{EN[0]} {EN[1]}</p><p>{EN[2]}</p></td></tr><tr><td>Copyright 2020</td></tr></table>", [f"{EN[0]} {EN[1]}", EN[2]]),
}
