"""Word lists, taxonomies and sentences that decide results, plus the default stop-word set.

Every operator takes these as parameters; the values below are the defaults.
"""

from __future__ import annotations

from functools import lru_cache

# --- Fixed values: keyword lists. All of them are substring tests on lower-cased text. ---

PAGE_RETURN_KEYWORDS = ["return", "returned", "returning", "refund", "refunded", "refunds"]
PAGE_WARRANTY_KEYWORDS = [
    "warranty", "warranties", "guarantee", "guaranteed", "claim", "claims",
]
PAGE_FOCUS_KEYWORDS = PAGE_RETURN_KEYWORDS + PAGE_WARRANTY_KEYWORDS + [
    "replacement", "defect", "defective", "repair", "broken", "damaged",
]

CLEAN_RETURN_KEYWORDS = [
    "return", "returned", "returning", "refund", "refunded", "chargeback",
]
CLEAN_WARRANTY_KEYWORDS = ["warranty", "guarantee", "claim", "claimed"]

FEATURE_RETURN_KEYWORDS = ["return", "refund", "returned", "replacement", "chargeback"]
FEATURE_WARRANTY_KEYWORDS = ["warranty", "guarantee", "claim", "coverage", "repair"]

# Ordered: the first label that applies is the primary label.
ISSUE_TAXONOMY = {
    "delivery_issue": ["late", "delivery", "shipped", "shipping", "arrive", "arrival"],
    "defective_product": [
        "defect", "defective", "broken", "malfunction", "stopped", "damaged", "faulty",
    ],
    "refund_return_issue": ["refund", "return", "returned", "replacement", "replace"],
    "warranty_claim_issue": ["warranty", "guarantee", "claim", "coverage", "covered"],
    "support_issue": ["support", "agent", "representative", "response", "unhelpful", "rude"],
    "billing_issue": ["charged", "charge", "billing", "payment", "invoice", "fee"],
}
OTHER_LABEL = "other"

# Ordered: the first entry whose label is present gives the sentence.
ROOT_CAUSES = {
    "defective_product":
        "Improve pre-shipment quality checks and strengthen supplier QA controls.",
    "warranty_claim_issue":
        "Clarify warranty terms and simplify claim verification and approval steps.",
    "refund_return_issue":
        "Shorten refund turnaround SLA and provide proactive return-status updates.",
    "delivery_issue":
        "Audit logistics partners and enforce stricter on-time delivery metrics.",
    "support_issue":
        "Train support agents and add escalation paths for unresolved complaints.",
    "billing_issue":
        "Add billing validation checks and transparent fee breakdowns at checkout.",
}
ROOT_CAUSE_DEFAULT = "Collect more examples to identify a stable root-cause pattern."

LABEL_SUGGESTIONS = {
    "defective_product": "Strengthen manufacturing QA and pre-dispatch product testing.",
    "warranty_claim_issue": "Simplify claim workflow and make warranty conditions clearer.",
    "refund_return_issue": "Automate refund approvals for validated return scenarios.",
    "delivery_issue": "Improve courier SLA monitoring and proactive customer notifications.",
    "support_issue": "Introduce support quality audits and escalation checkpoints.",
    "billing_issue": "Add billing anomaly detection before payment capture.",
    "other": "Collect additional training examples for more precise categorization.",
}

RELEVANCE_NOTES = {
    "warranty_claim_issue": "Directly supports warranty claim workflow analysis.",
    "refund_return_issue": "Directly supports return/refund policy optimization.",
    "defective_product": "Supports product quality and replacement decision-making.",
    "delivery_issue": "Supports post-purchase logistics and customer recovery.",
    "support_issue": "Supports customer support escalation and response quality.",
    "billing_issue": "Supports billing dispute and refund validation.",
    "other": "General complaint signal; may need additional domain labeling.",
}

NEGATIVE_CUES = [
    "denied", "refused", "failed", "broken", "defective", "scam", "fraud", "terrible",
    "awful", "worst", "unacceptable", "delay", "delayed", "ignored", "useless",
    "disappointed", "angry", "frustrated", "not honor", "would not", "won't", "cant", "cannot",
]
POSITIVE_CUES = [
    "resolved", "fixed", "replaced", "refunded", "helpful", "satisfied", "approved",
    "honored", "completed", "successful", "thank", "thanks", "working",
]

SUMMARY_FOCUS_TERMS = [
    "warranty", "return", "refund", "claim", "replacement", "repair", "defective",
]

EVALUATION_QUERIES = [
    ("warranty claim denied", ["warranty", "claim", "denied"]),
    ("refund not received", ["refund", "return", "not"]),
    ("defective product replacement", ["defective", "product", "replacement"]),
    ("repair under warranty", ["warranty", "repair"]),
]

# The common-English stop words that Spark ML's own English list lacks, and the
# words of that list that are not stop words here.
_ENGLISH_ADDED = """
across afterwards almost alone along already also although always among amongst amoungst amount
another anyhow anyone anything anyway anywhere around back became become becomes becoming
beforehand behind beside besides beyond bill bottom call cant co con couldnt cry de describe
detail done due eg eight either eleven else elsewhere empty enough etc even ever every everyone
everything everywhere except fifteen fifty fill find fire first five former formerly forty found
four front full get give go hasnt hence hereafter hereby herein hereupon however hundred ie inc
indeed interest keep last latter latterly least less ltd made many may meanwhile might mill mine
moreover mostly move much must name namely neither never nevertheless next nine nobody none noone
nothing nowhere often one onto others otherwise part per perhaps please put rather re see seem
seemed seeming seems serious several show side since sincere six sixty somehow someone something
sometime sometimes somewhere still system take ten thence thereafter thereby therefore therein
thereupon thick thin third though three throughout thru thus together top toward towards twelve
twenty two un upon us via well whatever whence whenever whereafter whereas whereby wherein
whereupon wherever whether whither whoever whole whose within without yet
"""
_ENGLISH_DROPPED = "does doing don having ought s t theirs"

# Words of feedback sites that carry no topic. Domain words (warranty, return,
# refund, claim, defective, ...) are kept on purpose.
_FEEDBACK_WORDS = """
would could got im ive didnt dont doesnt company service customer
did said say says saying told tell tells telling asked ask asks asking mentioned mention mentions
stated state states explained explain explains reported report reports reporting
really just quite maybe actually basically literally simply especially probably definitely
certainly okay yeah yes oh ah people person
went gone goes going come came comes coming look looked looking looks saw seen seeing
make makes making took taken takes taking gave given gives giving puts putting let lets
try tried tries trying use used uses using work worked working works think thinks thinking thought
know knew knows knowing want wanted wants wanting need needed needs needing like liked likes
called calling calls email emailed emails contact contacted contacting phone phones
thanks thank sorry instead anyways
review reviews complaint complaints business board website online
day days week weeks month months ago later earlier today yesterday tomorrow second
youre theyre weve isnt arent wasnt werent havent hadnt wont wouldnt shouldnt
"""


@lru_cache(maxsize=None)
def default_stopwords(site_name: str | None = None) -> tuple[str, ...]:
    """Spark ML's English list, adjusted, plus feedback-site words and the site's own name."""
    from pyspark.ml.feature import StopWordsRemover
    from pyspark.sql import SparkSession

    if SparkSession.getActiveSession() is None:
        SparkSession.builder.getOrCreate()
    built_in = {w for w in StopWordsRemover.loadDefaultStopWords("english") if "'" not in w}
    words = (built_in - set(_ENGLISH_DROPPED.split())) | set(_ENGLISH_ADDED.split())
    words |= set(_FEEDBACK_WORDS.split())
    if site_name:
        words.add(site_name.lower())
    return tuple(sorted(words))
