"""What registered queries make out of the tables to run on: lines, addresses and pages of the sites."""

from __future__ import annotations

# Lines as headings are written by hand, for each title of the catalog: number, word and rest.
FORMS = ("Chương{n}", "CHƯƠNG {n}: {t}", "Chap{n} {t}", "第{w}章 {t}", "第{n}话", "第{n}幕 {t}", "第{n}卷{t}", "Quyển 0{n}: {t}", "Quyển {n} - {t}", "Vol . {n} {t}", "Book {n}", "tập {n}.", "序幕／{t}", "序幕{t}", "终幕", "终章「{t}」{n}", "序章 （{t}）", "序章『{t}』", "Prologue\t{t}", "prologues {t}", "Epilogue:{n}", "後記 {t}", "前言", "{t}")

# Addresses of every site and of some that only look alike, with the page's number.
ADDRESSES = ("https://tw.hjwzw.com/Book/Read/{}", "https://tw.linovelib.com/novel/{}.html", "https://tw.zhswx.com/b/{}", "https://www.dxmwx.org/read/{}.html", "https://www.dxmwx.com/read/{}.html", "https://czbooks.net/n/{}", "https://www.piaotia.com/html/{}.html", "https://quanben.io/n/{}.html", "https://sto55.com/book/{}.html", "https://www.69shuba.com/txt/{}", "https://www.69shu.com/txt/{}", "https://www.69xinshu.com/txt/{}", "https://www.69shu.pro/txt/{}", "https://www.69shuba.pro/txt/{}", "https://quanben5.com/n/{}.html", "https://o.example/?u=piaotia&p={}", "https://www.69shuba.org/{}")

# Pages of each site around a chapter: {t} its title, {p} its paragraphs, {b} its lines with breaks, {f} in font elements, {n} the next page's address.
NAV = '<div class="nav"><div><a href="/">home</a></div></div>'
FOOT = '<div class="footer"><div><p>FOOTER</p><font>FOOTER</font></div></div>'
PAGES = {
    "hjwzw": NAV + '<h1>{t}</h1><div style="font-size: 20px; line-height: 30px; word-wrap: break-word; width: 750px;"><p>請記住本站域名: 黃金屋</p><p><a href="/b">book</a></p><div>{p}</div></div>' + FOOT,
    "tw": NAV + '<h1 id="atitle">{t}</h1><h3>卷一 <b>Vol</b></h3><div id="acontent"><div class="ad"><div>AD</div></div>{p}</div>' + FOOT,
    "quanben": NAV + '<h1 class="headline">{t}</h1><div class="articlebody"><div id="content"><!--PAGE 1-->{p}</div><p>AFTER</p></div>' + FOOT,
    "zhswx": NAV + '<h1>{t}</h1><div style="font-size: 20px; width: 700px; text-indent: 2em;"><div>{f}</div>AD</div>' + FOOT,
    "dxmwx": NAV + '<h1 id="ChapterTitle">{t}</h1><div id="Lab_Contents"><div>{i}</div><p>AD</p></div>' + FOOT,
    "piaotia": NAV + '<h1>書名 {t}</h1><div id="content"><div>TOP</div><br>{b}<div class="bottomlink"><a href="{n}">下一章</a></div></div>' + FOOT,
    "shuba": NAV + '<script>var bookinfo = {next_page: "{n}", chaptername: "x"}</script><div class="txtnav"><h1 class="hide720">{t}</h1><div class="txtinfo hide720"><span>DATE</span></div><div id="txtright"><script>loadAdv(2, 0);</script></div>{b}<div class="bottom-ad"><div>AD</div></div></div>' + FOOT,
    "sto55": NAV + '<h1 class="pt10">{t}</h1><div class="readcotent"><div class="ADVERTISEMENT"><div>AD</div></div>{b}本章節來源於 x<br><iframe>AD</iframe></div><a id="linkNext" href="{n}">n</a>' + FOOT,
    "czbooks": NAV + '<div class="name">{t}</div><div class="content"><div>{b}</div></div><a class="next-chapter" href="{n}">n</a>' + FOOT,
}
