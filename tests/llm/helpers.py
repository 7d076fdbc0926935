"""What several tests of this folder use."""

FOLDER = "/root/testdata/sf0.001"


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def by_id(df):
    return {r.doc_id: r for r in df.collect()}
