"""Stems of Portuguese words, in stages, as Spark expressions.

A word goes through plural, adverb, feminine and augmentative endings, then loses
a noun ending, or else a verb ending, or else its last vowel.  In each stage the first
rule that fits is applied: the word has the ending, what is left in front of it is long
enough, and the word is no exception.  Words are expected as `text.folded` gives them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from mercato.functions.text import tokens


@dataclass(frozen=True)
class Ending:
    """``text`` becomes ``to`` where at least ``least`` letters stand in front."""

    text: str
    least: int
    to: str = ""
    exceptions: tuple[str, ...] = ()


def _endings(least: int, *texts: str) -> list[Ending]:
    return [Ending(t, least) for t in texts]


def _longest_first(endings: list[Ending]) -> list[Ending]:
    return sorted(endings, key=lambda e: (-len(e.text), e.text))


PLURAL = [
    Ending("ns", 1, "m"), Ending("oes", 2, "ao"), Ending("aes", 1, "ao", ("maes",)), Ending("ais", 1, "al", ("mais", "cais", "demais", "jamais")),
    Ending("eis", 2, "el", ("reis", "seis")), Ending("ois", 2, "ol", ("depois", "dois", "pois")), Ending("res", 3, "r"), Ending("zes", 2, "z"), Ending("les", 3, "l"),
    Ending("is", 3, "il", ("lapis", "gratis", "oasis", "tenis")), Ending("s", 2, "", ("lapis", "onibus", "virus", "tenis", "gratis", "mais", "menos", "antes", "apenas", "depois", "atras", "pires", "tres")),
]
ADVERB = [Ending("mente", 4, "", ("experimente", "aumente", "comente", "apresente"))]
FEMININE = [
    Ending("inha", 3, "inho", ("rainha", "linha", "minha", "cozinha", "farinha")), Ending("ona", 3, "ao", ("carona", "poltrona")), Ending("ora", 3, "or", ("agora", "embora", "demora", "senhora")),
    Ending("eira", 3, "eiro", ("beira", "cadeira", "geladeira", "madeira", "bandeira")), Ending("osa", 3, "oso", ("mucosa", "prosa")), Ending("esa", 3, "es", ("mesa", "empresa", "despesa", "surpresa", "framboesa")),
    Ending("iva", 3, "ivo", ("saliva", "gengiva")), Ending("ica", 3, "ico", ("fabrica", "musica", "logica", "metrica")), Ending("ada", 3, "ado", ("camada", "entrada", "escada", "pitada", "tomada")),
    Ending("ida", 3, "ido", ("avenida", "bebida", "medida", "partida", "saida", "vida", "comida")), Ending("ina", 4, "ino", ("gasolina", "cortina", "piscina", "maquina", "vitamina")), Ending("ima", 3, "imo", ("vitima", "lagrima")),
]
AUGMENTATIVE = [
    Ending("bilissimo", 3, "vel"), Ending("issimo", 3), Ending("zinho", 3, "", ("vizinho",)), Ending("quinho", 3, "c"), Ending("inho", 3, "", ("caminho", "carinho", "vizinho", "focinho")),
    Ending("zarrao", 3), Ending("zao", 3, "", ("coalizao",)),
]
NOUN = _longest_first(
    _endings(3, "agem", "amento", "imento", "ador", "edor", "acao", "icao", "encia", "eiro", "oso", "ario", "eza", "ismo", "avel", "ivel", "ivo", "ido", "iario")
    + _endings(4, "ancia", "idade", "ista", "ico", "ense", "ura", "idor", "ado", "mento", "ice", "tude", "ional", "ial")
    + _endings(5, "abilidade", "ibilidade", "izacao", "alizacao", "izador", "alista", "alismo", "izado")
    + [Ending("cao", 3, "", ("nacao", "racao")), Ending("al", 4, "", ("animal", "hospital", "material", "capital")), Ending("ez", 4), Ending("ante", 3, "", ("durante", "instante", "elefante", "restante"))]
)
# A conjugation has a theme vowel, and most forms are that vowel and one of these.
# The plural stage has taken the last letter of forms in -mos already.
TENSES = ("r", "ndo", "mo", "ram", "ria", "riam", "riamo", "rao", "ra", "rei", "remo", "sse", "ssem", "ssemo", "rem", "rmo", "ste", "do")
VERB = _longest_first(
    [Ending(vowel + tense, 2 if vowel == "a" else 3) for vowel in "aei" for tense in TENSES]
    + _endings(2, "ava", "avam", "avamo", "ou", "eu", "iu", "iam", "iamo") + _endings(3, "am", "em", "ia", "ei")
)
VOWEL = [Ending(v, 3) for v in ("ao", "a", "e", "o")]


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is mentioned."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _applied(word: Column, endings: list[Ending]) -> Column:
    """The word after the first rule that fits; NULL if none does."""
    rules = F.array(*[
        F.struct(F.lit(e.text).alias("text"), F.lit(e.least + len(e.text)).alias("least"), F.lit(e.to).alias("to"), F.array(*map(F.lit, e.exceptions)).cast("array<string>").alias("spared"))
        for e in endings
    ])
    # The rules are one constant, so the plan stays small whatever their number.
    fits = F.filter(rules, lambda r: F.endswith(word, r["text"]) & (F.length(word) >= r["least"]) & ~F.array_contains(r["spared"], word))
    return bound(F.get(fits, F.lit(0)), lambda r: F.when(r.isNotNull(), F.concat(F.left(word, F.length(word) - F.length(r["text"])), r["to"])))


def stemmed(word: Column) -> Column:
    """The stem of a folded word; NULL for NULL, and words of other scripts stay as they are."""

    def stage(endings: list[Ending], when: Callable[[Column], Column] | None = None) -> Callable[[Column], Column]:
        def run(w: Column) -> Column:
            changed = F.coalesce(_applied(w, endings), w)
            return changed if when is None else F.when(when(w), changed).otherwise(w)

        return run

    stages = [
        stage(PLURAL, lambda w: w.endswith("s")), stage(ADVERB), stage(FEMININE, lambda w: w.endswith("a")), stage(AUGMENTATIVE),
        lambda w: F.coalesce(_applied(w, NOUN), _applied(w, VERB), _applied(w, VOWEL), w),
    ]
    for run in stages:
        word = bound(word, run)
    return word


def stems(text: Column) -> Column:
    """Stems of a text's words without stop words, in order, repeats kept."""
    return F.transform(tokens(F.coalesce(text, F.lit(""))), stemmed)
