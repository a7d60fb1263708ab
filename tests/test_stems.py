"""Stems of further languages against pairs of the published sample vocabularies."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from presslens.functions import stemming

# Word and stem of the published sample vocabularies.
PAIRS = {
    "english": """
    consign:consign consigned:consign consigning:consign consignment:consign consist:consist consisted:consist
    consistency:consist consistent:consist consistently:consist consisting:consist consists:consist consolation:consol
    consolations:consol consolatory:consolatori console:consol consoled:consol consoles:consol consolidate:consolid
    consolidated:consolid consolidating:consolid consoling:consol consolingly:consol consols:consol consonant:conson
    consort:consort consorted:consort consorting:consort conspicuous:conspicu conspicuously:conspicu conspiracy:conspiraci
    conspirator:conspir conspirators:conspir conspire:conspir conspired:conspir conspiring:conspir constable:constabl
    constables:constabl constance:constanc constancy:constanc constant:constant knack:knack knackeries:knackeri knacks:knack
    knag:knag knave:knave knaves:knave knavish:knavish kneaded:knead kneading:knead knee:knee kneel:kneel kneeled:kneel
    kneeling:kneel kneels:kneel knees:knee knell:knell knelt:knelt knew:knew knick:knick knif:knif knife:knife knight:knight
    knightly:knight knights:knight knit:knit knits:knit knitted:knit knitting:knit knives:knive knob:knob knobs:knob
    knock:knock knocked:knock knocker:knocker knockers:knocker knocking:knock knocks:knock knopp:knopp knot:knot knots:knot
    skies:sky dying:die news:news happy:happi hopping:hop hoping:hope generate:generat
    """,
    "german": """
    aufeinander:aufeinand aufeinanderbiss:aufeinanderbiss aufeinanderfolge:aufeinanderfolg aufeinanderfolgen:aufeinanderfolg
    aufeinanderfolgend:aufeinanderfolg aufeinanderfolgende:aufeinanderfolg aufeinanderfolgenden:aufeinanderfolg
    aufeinanderfolgender:aufeinanderfolg aufeinanderfolgt:aufeinanderfolgt aufeinanderfolgten:aufeinanderfolgt
    aufeinanderschlügen:aufeinanderschlug aufenthalt:aufenthalt aufenthalten:aufenthalt aufenthaltes:aufenthalt
    auferlegen:auferleg auferlegt:auferlegt auferlegten:auferlegt auferstand:auferstand auferstanden:auferstand
    auferstehen:aufersteh aufersteht:aufersteht auferstehung:aufersteh auferstünde:auferstund auferwecken:auferweck
    auferweckt:auferweckt auferzogen:auferzog aufessen:aufess kategorie:kategori kategorien:kategori kategorisch:kategor
    kategorische:kategor kategorischen:kategor kategorischer:kategor kater:kat katers:kat katze:katz katzen:katz
    katzenschmer:katzenschm kätzchen:katzch kauen:kau kauerte:kauert kauf:kauf kaufen:kauf kaufer:kauf käufer:kauf
    kaufherr:kaufherr kaufleute:kaufleut kaum:kaum kaumdaß:kaumdass
    """,
    "spanish": """
    cheque:chequ chequeo:cheque cheques:chequ cheyenne:cheyenn chi:chi chía:chi chiapaneca:chiapanec chiapas:chiap
    chiba:chib chic:chic chica:chic chicago:chicag chicana:chican chicano:chican chicas:chic chicharrones:chicharron
    chichen:chich chichimecas:chichimec chicles:chicl chico:chic torá:tor tórax:torax torcer:torc toreado:tor toreados:tor
    toreándolo:tor torear:tor toreara:tor torearlo:tor toreó:tore torero:torer toreros:torer torio:tori tormenta:torment
    tormentas:torment tornado:torn tornados:torn tornar:torn tornen:torn torneo:torne torneos:torne tornillo:tornill
    toro:tor toros:tor torpe:torp torpedo:torped
    """,
    "french": """
    continu:continu continua:continu continuait:continu continuant:continu continuation:continu continue:continu
    continué:continu continuel:continuel continuelle:continuel continuellement:continuel continuelles:continuel
    continuels:continuel continuer:continu continuera:continu continuerait:continu continueront:continu continuez:continu
    continuité:continu continuons:continuon contorsions:contors contour:contour contournait:contourn contournant:contourn
    contours:contour contractait:contract contracté:contract contractée:contract contracter:contract contractés:contract
    contractions:contract contradictoirement:contradictoir contradictoires:contradictoir contraindre:contraindr
    contraint:contraint contrainte:contraint contraintes:contraint contraire:contrair contraires:contrair contraria:contrari
    main:main mains:main maintenaient:mainten maintenait:mainten maintenant:mainten maintenir:mainten maintenue:maintenu
    maintien:maintien maintint:maintint maire:mair maires:mair mairie:mair mais:mais maïs:maï maison:maison maisons:maison
    maistre:maistr maitre:maitr maître:maîtr maîtres:maîtr maîtresse:maîtress maîtresses:maîtress majesté:majest
    majestueuse:majestu majestueusement:majestu majestueux:majestu majeur:majeur majeure:majeur major:major
    majordome:majordom majordomes:majordom majorité:major majorités:major mal:mal malacca:malacc malade:malad malades:malad
    maladie:malad maladies:malad maladive:malad
    """,
}


@pytest.mark.parametrize("language", PAIRS)
def test_published_pairs(language):
    pairs = [p.split(":") for p in PAIRS[language].split()]
    assert len(pairs) > 40
    assert {w: stemming.STEMMERS[language](w) for w, _ in pairs} == dict(pairs)


@pytest.mark.parametrize("language", PAIRS)
def test_awkward_words(language):
    for word in ["", "a", "y", "é", "s", "qu", "'", "'s'", "zz", "eaux", "uyendo", "ee", "ß", "1", "漢字", "y" * 50, "aeiou" * 20]:
        assert isinstance(stemming.STEMMERS[language](word), str)


def test_by_row(spark):
    rows = [(1, ["knives", "katzen", "toros"], "en"), (2, ["knives", "katzen", "", "toros"], "de"), (3, ["toros", None], "Spanish"),
            (4, ["quilos"], "pt"), (5, ["knives"], None), (6, ["knives"], "xx"), (7, None, "en"), (8, [], "fr"), (9, ["maladies"], "fr")]
    df = spark.createDataFrame(rows, "id long, w array<string>, lang string").repartition(3)
    got = {r.id: r.s for r in df.select("id", stemming.stem_by_language("w", "lang").alias("s")).collect()}
    assert got == {1: ["knive", "katzen", "toro"], 2: ["kniv", "katz", "", "toros"], 3: ["tor", None], 4: ["quil"], 5: ["knives"], 6: ["knives"], 7: None, 8: [], 9: ["malad"]}
    assert df.select(F.size(stemming.stem_by_language("w", "lang"))).count() == 9


def test_words_are_counted_before_they_are_stemmed(spark, sf):
    """Python gets each distinct word once, so what it holds does not follow the texts."""
    from presslens.catalog import load

    for name in ("stem_vocabulary", "stem_by_language"):
        plan = load()[0][name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        below = plan[plan.index("ArrowEvalPython") :]
        assert "Aggregate [" in below and "Generate explode" in below[below.index("Aggregate [") :]
