import os

from catalogprep.plans.catalog_job import clean_titles
from catalogprep.sources import lookups
from catalogprep.sources.readers import read_titles_csv
from catalogprep.streaming import start_clean_stream

HEADER = "show_id,type,title,director,cast,country,date_added,release_year,rating,duration,listed_in,description\n"
BATCH1 = 'a1,Movie,One,D,C,"United States, Atlantis","July 24, 2020",2020,PG,100 min,"International Movies",x\n'
BATCH2 = ('a2,TV Show,Two,,C,"Canada, Costa Rica","May 1, 2019",2019,TV-14,3 Seasons,Docuseries,y\n'
          'a3,Movie,Three,D,C,Hungary,"May 2, 2019",2019,PG,90 min,Dramas,\n')


def test_stream_equals_batch_keep_all(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    for i, body in enumerate([BATCH1, BATCH2]):
        with open(os.path.join(src, f"part{i}.csv"), "w") as f:
            f.write(HEADER + body)
    valid, langs = lookups.valid_countries_df(spark), lookups.language_map_df(spark)
    out = os.path.join(tmp_dir, "out")
    q = start_clean_stream(spark, src, out, os.path.join(tmp_dir, "ckpt"), valid, langs, available_now=True)
    q.awaitTermination(120)
    streamed = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    raw = read_titles_csv(spark, src, keep_corrupt=False)
    batch = sorted(tuple(r) for r in clean_titles(raw, valid, langs, mode="keep_all").titles.collect())
    assert streamed == batch
    assert [r[0] for r in streamed] == ["a1", "a2"]  # a3 has a null description
