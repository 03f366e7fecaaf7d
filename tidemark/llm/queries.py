"""Name -> query for the corpus operators, and the SQL twins of those SQL can express."""

from tidemark.llm import (
    centroids,
    decontam,
    fingerprints,
    langid,
    packing,
    pieces,
    repeats,
    secrets,
    simhash,
    toxicity,
    urlfilter,
    warc,
    whitening,
)

QUERIES = {
    "op1_fingerprints": fingerprints.op1_fingerprints,
    "op2_simhash": simhash.op2_simhash,
    "op3_langid": langid.op3_langid,
    "op4_url_filter": urlfilter.op4_url_filter,
    "op5_warc": warc.op5_warc,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_packing": packing.op7_packing,
    "op8_repeats": repeats.op8_repeats,
    "op9_decontamination": decontam.op9_decontamination,
    "op10_secret_scans": secrets.op10_secret_scans,
    "op11_whitening": whitening.op11_whitening,
    "op12_centroids": centroids.op12_centroids,
    "op13_pieces": pieces.op13_pieces,
}
ORACLES: dict[str, str] = {
    "op4_url_filter": urlfilter.ORACLE,
    "op5_warc": warc.ORACLE,
    "op12_centroids": centroids.ORACLE,
}
