"""Word families of Portuguese, written down by hand: one stem within a family, another in each other one."""

import duckdb
from pyspark.sql import functions as F

from mercato.checks import ORACLES, QUERIES
from mercato.functions import stemming, text

FAMILIES = [
    ["menino", "menina", "meninos", "meninas"], ["produto", "produtos"], ["rapido", "rapida", "rapidos", "rapidamente"], ["papel", "papeis"], ["lencol", "lencois"],
    ["comprar", "comprando", "comprava", "compraram", "compramos", "comprei", "comprou", "compra", "compras"], ["vender", "vendendo", "vendemos", "venderam", "vendeu"],
    ["cadeira", "cadeiras"], ["entrega", "entregas", "entregar", "entregaram", "entregou"], ["mulher", "mulheres"], ["perigoso", "perigosa", "perigosos", "perigosas"],
    ["brasileiro", "brasileira", "brasileiros"], ["lapis"], ["mesa", "mesas"], ["mais"], ["dificilimo"], ["pessimo", "pessima"], ["viagem", "viagens"], ["juiz", "juizes"],
    ["quadrado", "quadrada"], ["felicidade", "felicidades"], ["gatinho", "gatinha", "gatinhos"], ["caminho", "caminhos"], ["informacao", "informacoes"], ["hospital", "hospitais"],
]


def stem_all(spark, words):
    rows = spark.createDataFrame([(w,) for w in words], "w STRING").select("w", stemming.stemmed(F.col("w")).alias("s")).collect()
    return {r.w: r.s for r in rows}


def test_families(spark):
    stems = stem_all(spark, [w for family in FAMILIES for w in family])
    split = {tuple(family): sorted({stems[w] for w in family}) for family in FAMILIES if len({stems[w] for w in family}) > 1}
    assert not split
    assert len({stems[family[0]] for family in FAMILIES}) == len(FAMILIES)


def test_exceptions_and_short_words_stay(spark):
    stems = stem_all(spark, ["lapis", "mais", "onibus", "sol", "de", "", "src5", "w12x", "中文", None])
    assert stems == {w: w for w in stems}


def test_stems_of_a_text(spark):
    row = spark.createDataFrame([("As Informações rápidas, RAPIDAMENTE!", None)], "t STRING, n STRING").select(stemming.stems(F.col("t")).alias("t"), stemming.stems(F.col("n")).alias("n")).first()
    assert len(row.t) == 3 and row.t[1] == row.t[2] and row.n == []
    assert "as" in text.STOP_WORDS


def test_stem_frequency_of_repeated_and_missing_ids(spark, tmp_path, capsys):
    """Documents are counted by id, once over repeated rows and never for NULL; occurrences are not stemmed one by one."""
    data = [(1, "Casas casa casas azul"), (1, "azul azul verde"), (2, "verde casa"), (None, "azul cinza"), (3, None), (4, "")]
    spark.createDataFrame(data, "doc_id BIGINT, text STRING").write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["stem_frequency"](spark, str(tmp_path))
    rows = sorted(tuple(r) for r in found.collect())
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert rows == sorted(connection.execute(ORACLES["stem_frequency"]).fetchall()) and len(rows) == 4
    assert {r[0]: r[3] for r in rows}["cinz"] == 0
    found.explain()
    assert "mente" not in capsys.readouterr().out
