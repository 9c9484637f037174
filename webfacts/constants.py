"""What every operator must agree on for results to be right."""

# --- fixed values: archive and page layout --------------------------------
RECORD_MARK = "WARC/1.0"
KEY_NAME = "WARC-TREC-ID"
KEY_SEPARATOR = ": "
HTML_START = "<html"

# Elements removed together with their content, and void elements of the same
# list, which have no content to remove.
DROP_ELEMENTS = ["iframe", "script", "style", "noscript", "header", "head", "a"]
DROP_VOID = ["meta", "input"]

# --- fixed values: sentences and tokens -----------------------------------
SENTENCE_ENDS = "?!.？！。…"

# Two-part words that the word tokeniser separates.
CONTRACTIONS = [
    ("can", "not"), ("gim", "me"), ("gon", "na"),
    ("got", "ta"), ("lem", "me"), ("wan", "na"),
]

# English stop words of the NLTK corpus.
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours
yourself yourselves he him his himself she she's her hers herself it it's its
itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down
in out on off over under again further then once here there when where why how
all any both each few more most other some such no nor not only own same so
than too very s t can will just don don't should should've now d ll m o re ve y
ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn
hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't
shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn
wouldn't
""".split()

# --- fixed values: entity labels that are never kept ----------------------
IGNORED_LABELS = [
    "DATE", "TIME", "CARDINAL", "ORDINAL", "QUANTITY", "PERCENT", "MONEY",
]

# --- fixed values: full-text ranking (BM25 as the Lucene family defines it)
BM25_K1 = 1.2
BM25_B = 0.75
TOP_K = 10

# --- fixed values: relation features --------------------------------------
# (branch, feature column, kind of term), in vector order.
FEATURE_BRANCHES = [
    ("e1", "e1", "word"),
    ("e2", "e2", "word"),
    ("e1_e2", "e1_e2", "whitespace"),
    ("e1_e2_bigram", "e1_e2", "bigram"),
    ("head_e1", "head_e1", "word"),
    ("head_e2", "head_e2", "word"),
    ("head_e1_e2", "head_e1_e2", "whitespace"),
    ("head_e1_e2_bigram", "head_e1_e2", "bigram"),
    ("e1_ner", "e1_ner", "word"),
    ("e2_ner", "e2_ner", "word"),
    ("e1_e2_ner", "e1_e2_ner", "word"),
    ("e1_postag", "e1_postag", "word"),
    ("e2_postag", "e2_postag", "word"),
    ("before_e1", "before_e1", "whitespace"),
    ("after_e2", "after_e2", "whitespace"),
    ("between_e1_e2", "between_e1_e2", "whitespace"),
    ("before_e1_bigram", "before_e1", "bigram"),
    ("after_e2_bigram", "after_e2", "bigram"),
    ("between_e1_e2_bigram", "between_e1_e2", "bigram"),
    ("shortest_path", "shortest_path", "word"),
    ("sentence_string", "sentence_string", "word"),
]

# Feature columns whose missing values become the text "nan".
NAN_COLUMNS = [
    "input_sentence", "input_relation", "e1", "e2", "e1_e2",
    "head_e1", "head_e2", "head_e1_e2", "before_e1", "between_e1_e2",
    "after_e2", "e1_ner", "e2_ner", "e1_postag", "e2_postag", "e1_e2_ner",
    "relation", "direction", "sentence_string",
]
NAN_TEXT = "nan"
NONE_TEXT = "None"

# --- fixed values: relation labels of the classifier with name and link ----
# Trailing blanks belong to the names.
RELATION_DICTIONARY = [
    ("Cause-Effect e1,e2", "has cause", "https://www.wikidata.org/wiki/Property:P828"),
    ("Cause-Effect e2,e1", "has effect ", "https://www.wikidata.org/wiki/Property:P1542"),
    ("Component-Whole e1,e2", "part of", "https://www.wikidata.org/wiki/Property:P361"),
    ("Component-Whole e2,e1", "consist of", "https://www.wikidata.org/wiki/Q55692548"),
    ("Content-Container e1,e2", "content", "https://www.wikidata.org/wiki/Q1260632"),
    ("Content-Container e2,e1", "container", "https://www.wikidata.org/wiki/Q987767"),
    ("Entity-Destination e1,e2", "entity", "https://www.wikidata.org/wiki/Q35120"),
    ("Entity-Destination e2,e1", "destination point ", "https://www.wikidata.org/wiki/Property:P1444"),
    ("Entity-Origin e1,e2", "entity", "https://www.wikidata.org/wiki/Q35120"),
    ("Entity-Origin e2,e1", "origin", "https://www.wikidata.org/wiki/Q3885844"),
    ("Instrument-Agency e1,e2", "instrument", "https://www.wikidata.org/wiki/Property:P1303"),
    ("Instrument-Agency e2,e1", "agency", "https://www.wikidata.org/wiki/Q352450"),
    ("Member-Collection e1,e2", "member", "https://www.wikidata.org/wiki/Q9200127"),
    ("Member-Collection e2,e1", "collection", "https://www.wikidata.org/wiki/Q2668072"),
    ("Message-Topic e1,e2", "message", "https://www.wikidata.org/wiki/Q628523"),
    ("Message-Topic e2,e1", "topic", "https://www.wikidata.org/wiki/Q200801"),
    ("Product-Producer e1,e2", "product", "https://www.wikidata.org/wiki/Q2424752"),
    ("Product-Producer e2,e1", "producer", "https://www.wikidata.org/wiki/Property:P162"),
    ("Other nan", None, None),
]

# --- fixed values: model settings -----------------------------------------
SVM_C = 1000.0
SVM_C_GRID = [0.1, 1.0, 10.0, 100.0, 1000.0, 10000.0]
TRAIN_SHARE = 0.7
SPLIT_SEED = 111

# --- fixed values: result lines -------------------------------------------
ENTITY_PREFIX = "ENTITY: "
RELATION_PREFIX = "RELATION: "
