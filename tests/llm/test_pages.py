"""Pages of any language and layout keep their whole article."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tilelake.llm import pages

TEXTS = {
    "it": ["Il vecchio ponte di pietra attraversa il fiume poco prima della città e ogni mattina i contadini lo percorrono con i loro carri pieni di verdura, mentre sulla riva opposta le barche aspettano che la nebbia si alzi.",
           "Nel corso degli anni il ponte fu rifatto tre volte, perché le piene della primavera portavano via gli archi più bassi; oggi una lapide ricorda il nome dei muratori che lo salvarono dopo la guerra."],
    "pt": ["A velha ponte de pedra atravessa o rio pouco antes da cidade e todas as manhãs os camponeses passam por ela com os seus carros cheios de legumes, enquanto na outra margem os barcos esperam que o nevoeiro levante.",
           "Ao longo dos anos a ponte foi refeita três vezes, porque as cheias da primavera levavam os arcos mais baixos; hoje uma placa recorda o nome dos pedreiros que a salvaram depois da guerra."],
    "pl": ["Stary kamienny most przecina rzekę tuż przed miastem i każdego ranka rolnicy jadą przez niego z wozami pełnymi warzyw, a na drugim brzegu łodzie czekają, aż podniesie się mgła nad wodą i łąkami.",
           "W ciągu wielu lat most był odbudowany trzy razy, bo wiosenne powodzie zabierały najniższe łuki; dziś tablica przypomina nazwiska murarzy, którzy go uratowali po wojnie, kiedy nie było ani kamienia, ani pieniędzy."],
    "ja": ["古い石の橋は町のすぐ手前で川を渡り、毎朝農夫たちが野菜を積んだ荷車でそこを通る。向こう岸では霧が晴れるのを舟が待っている。橋のたもとには小さな茶屋があり、旅人はそこで一休みしてから町に入る。",
           "長い年月のあいだに橋は三度造り直された。春の大水が低い迫持をさらっていったからである。いまは一枚の石碑が、戦のあとで橋を救った石工たちの名を伝えている。その名を読む人は、いまでは少なくなった。"],
    "tr": ["Eski taş köprü şehrin hemen önünde nehri geçer ve her sabah çiftçiler sebze dolu arabalarıyla bu köprüden geçerler, karşı kıyıda ise kayıklar sisin kalkmasını ve güneşin yükselmesini sabırla beklerler.",
           "Yıllar boyunca köprü üç kez yeniden yapıldı, çünkü bahar taşkınları en alçak kemerleri alıp götürüyordu; bugün bir levha, savaştan sonra köprüyü kurtaran taş ustalarının adlarını gelip geçenlere hatırlatır."],
    "ru": ["Старый каменный мост пересекает реку у самого города, и каждое утро крестьяне едут по нему с возами, полными овощей, а на другом берегу лодки ждут, когда над водой и лугами поднимется туман.",
           "За многие годы мост перестраивали три раза, потому что весенние паводки уносили самые низкие арки; теперь доска напоминает имена каменщиков, которые спасли его после войны, когда не было ни камня, ни денег."],
    "en": ["The old stone bridge crosses the river just before the town and every morning the farmers come over it with their carts full of greens, while on the other bank the boats wait for the mist to lift from the water.",
           "Over the years the bridge was built anew three times, since the floods of the spring took the lowest arches away; today a stone tells the names of the masons who saved it after the war was over."],
    "sv": ["Den gamla stenbron går över ån strax före staden och varje morgon kommer bönderna över den med sina kärror fulla av grönsaker, medan båtarna på den andra stranden väntar på att dimman ska lätta från vattnet.",
           "Under årens lopp byggdes bron om tre gånger, för att vårens flod tog bort de lägsta valven; i dag minner en tavla om namnen på de murare som räddade den efter kriget när det inte fanns någon sten."],
}
MENU = "<nav><a href='/'>Home</a> <a href='/a'>News</a></nav><ul class='menu'><li><a href='/b'>About</a></li></ul>"
FOOT = "<footer>© 2024 The Bridge Post</footer><div>© all rights kept</div>"


@pytest.mark.parametrize("lang", sorted(TEXTS))
@pytest.mark.parametrize("around", ["<div>{}</div>", "<div id='hidden-gems'>{}</div>", "<div class='social-policy'>{}</div>", "<div class='widget'><div>{}</div></div>", "<article>{}</article>"])
def test_article_of_any_language(lang, around):
    first, second = TEXTS[lang]
    page = MENU + around.format(f"<h1>1908</h1><p>{first}</p><p>{second}</p>") + FOOT
    assert pages.main_text(page) == f"1908\n\n{first}\n\n{second}"


def test_paragraphs_with_signs_and_links_stay():
    first, second = TEXTS["en"]
    linked = f"<p><a href='/x'>{first[:120]}</a>{first[120:]}</p>"
    signed = f"<p>{second} © the masons' guild</p>"
    body = f"<article><p>{first}</p>{linked}{signed}<ul><li><a href='/m'>More of this</a></li></ul></article>"
    assert pages.main_text(MENU + body + FOOT) == f"{first}\n\n{first}\n\n{second} © the masons' guild"
    notice = "<div class='cookie'><p>We use cookies. Some of them are needed.</p></div>"
    assert pages.main_text(notice + f"<div><p>{first}</p><p>{second}</p></div>") == f"{first}\n\n{second}"


def test_columns_of_any_name(spark):
    html = "<article><p>" + TEXTS["en"][0] + "</p></article>"
    df = spark.createDataFrame([(1, html)], "page_id long, html string").withColumn("a.b", F.lit("x")).withColumn("s", F.struct(F.lit(1).alias("x y")))
    found = pages.extract(df.withColumn("TEXT", F.lit("old")))
    assert found.columns == ["page_id", "a.b", "s", "text", "n_chars"] and found.first()["text"] == TEXTS["en"][0]
