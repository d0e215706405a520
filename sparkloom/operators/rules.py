"""Rules and patterns: scoring, ladders, mining, triangulation, confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ladder(steps: list[tuple[Column, Column | str]], last: Column | str | None = None) -> Column:
    """The value of the first true condition."""
    out = None
    for cond, value in steps:
        value = F.lit(value) if isinstance(value, str) else value
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(F.lit(last) if not isinstance(last, Column) else last)


def best_pattern(items: DataFrame, key: list[str], patterns: list[tuple[str, int, list[Column]]], none: str = "none") -> DataFrame:
    """The pattern with most true rules at its threshold or above; of equal scores the first listed."""
    scored = []
    for i, (name, threshold, some) in enumerate(patterns):
        score = sum((F.coalesce(r, F.lit(False)).cast("int") for r in some), F.lit(0))
        scored.append(F.struct(F.when(score >= threshold, score).otherwise(0).alias("score"), F.lit(-i).alias("place"), F.lit(name).alias("name")))
    best = items.select(*key, F.array_max(F.array(*scored)).alias("best"))
    return best.select(*key, F.when(F.col("best.score") > 0, F.col("best.name")).otherwise(none).alias("pattern"), F.col("best.score").alias("matched"))


def triangulated(rules: DataFrame, evidence: DataFrame, key: str, streams: dict[str, list[str]], category: str = "category") -> DataFrame:
    """Score of corroborating over applicable streams, status, and confidence moved by it.

    ``streams``: the streams that apply to each category. STRONG at 0.60 adds
    0.05 up to 0.97, WEAK below 0.33 takes 0.10 down to 0.10.
    """
    applies = F.lit(0)
    for name, some in streams.items():
        applies = F.when(F.col(category) == name, F.lit(len(some))).otherwise(applies)
    allowed = [(n, s) for n, some in streams.items() for s in some]
    table = rules.sparkSession.createDataFrame(allowed, f"{category} string, stream string")
    hits = evidence.join(rules.select(key, category), key).join(F.broadcast(table), [category, "stream"]).groupBy(key).agg(F.count_distinct("stream").alias("corroborating"))
    out = rules.withColumn("applicable", applies).join(hits, key, "left").withColumn("corroborating", F.coalesce("corroborating", F.lit(0).cast("long")))
    score = F.when(F.col("applicable") == 0, 0.0).otherwise(F.col("corroborating") / F.col("applicable"))
    out = out.withColumn("score", F.round(score, 4)).withColumn("status", F.when(score >= 0.6, "STRONG").when(score >= 0.33, "MODERATE").otherwise("WEAK"))
    moved = F.when(F.col("status") == "STRONG", F.least(F.lit(0.97), F.col("confidence") + 0.05)).when(F.col("status") == "WEAK", F.greatest(F.lit(0.1), F.col("confidence") - 0.1)).otherwise(F.col("confidence"))
    return out.withColumn("confidence", F.round(moved, 4))


def boosted(confidence: Column, path: Column, cap: float = 0.97) -> Column:
    """Confidence raised by the confidence of the best path, with a cap."""
    return F.least(F.lit(cap), confidence + F.when(path >= 0.75, 0.08).when(path >= 0.5, 0.04).otherwise(0.0))


def path_confidence(*parts: Column, base: float = 0.25, each: float = 0.1, cap: float = 0.85) -> Column:
    """A base and a bonus for each true part, with a cap."""
    return F.least(F.lit(cap), sum((F.when(p, F.lit(each)).otherwise(0.0) for p in parts), F.lit(base)))


def assigned(files: DataFrame, modules: DataFrame, weights: dict[str, float], threshold: float = 1.5, bonus: Column | None = None) -> DataFrame:
    """``file, module, score``: the module of highest weighted overlap at the threshold or above.

    ``files`` and ``modules`` are ``(file|module, kind, value)``; each shared
    value of a kind adds the kind's weight. Ties go to the smallest module.
    """
    weight = F.lit(0.0)
    for kind, w in weights.items():
        weight = F.when(F.col("kind") == kind, F.lit(w)).otherwise(weight)
    score = F.sum(weight) + (bonus if bonus is not None else 0.0)
    shared = files.distinct().join(modules.distinct(), ["kind", "value"]).groupBy("file", "module").agg(score.alias("score")).where(F.col("score") >= threshold)
    return shared.groupBy("file").agg(F.min_by("module", F.struct(-F.col("score"), F.col("module"))).alias("module"), F.max("score").alias("score"))


def schema_rules(columns: DataFrame) -> DataFrame:
    """A rule for each NOT NULL and UNIQUE column of ``table, column, nullable, unique``."""
    required = columns.where("not nullable").select("table", "column", F.lit("validation").alias("category"), F.concat(F.col("column"), F.lit(" of "), F.col("table"), F.lit(" is required")).alias("description"))
    unique = columns.where("unique").select("table", "column", F.lit("uniqueness").alias("category"), F.concat(F.col("column"), F.lit(" of "), F.col("table"), F.lit(" is unique")).alias("description"))
    return required.unionByName(unique)


#: Kinds of external systems, the beginnings of environment variables and the words in names that tell them.
EXTERNAL = (
    ("PAYMENT", "STRIPE_ PAYPAL_ BRAINTREE_ SQUARE_ RAZORPAY_ MOLLIE_ ADYEN_ CHECKOUT_", "stripe paypal braintree razorpay mollie adyen checkout payment.gateway payu"),
    ("EMAIL", "MAIL_ MAILGUN_ SENDGRID_ SES_ POSTMARK_ SPARKPOST_ MAILCHIMP_ SMTP_", "mailgun sendgrid postmark sparkpost mailchimp aws.ses smtp.mailer"),
    ("STORAGE", "AWS_ S3_ GCS_ AZURE_ DO_SPACES_ MINIO_ BACKBLAZE_ CLOUDINARY_", "s3bucket awss3 gcs azureblob cloudinary imagekit imgix digitalocean.spaces"),
    ("SMS_PUSH", "TWILIO_ VONAGE_ NEXMO_ PUSHER_ FIREBASE_ ONE_SIGNAL_ ONESIGNAL_ TELEGRAM_ SLACK_", "twilio vonage nexmo pusher firebase onesignal telegram.bot slack.webhook"),
    ("AUTH_OAUTH", "GOOGLE_ FACEBOOK_ GITHUB_ TWITTER_ AUTH0_ OKTA_ KEYCLOAK_ SOCIALITE_ OAUTH_ LDAP_", "google.oauth facebook.login auth0 okta keycloak socialite passport ldap"),
    ("MONITORING", "SENTRY_ BUGSNAG_ ROLLBAR_ DATADOG_ NEWRELIC_ LOGROCKET_ RAYGUN_", "sentry bugsnag rollbar datadog newrelic logrocket raygun"),
    ("CRM", "SALESFORCE_ HUBSPOT_ ZOHO_ PIPEDRIVE_ FRESHDESK_ ZENDESK_ INTERCOM_", "salesforce hubspot zoho pipedrive freshdesk zendesk intercom"),
    ("ERP", "QUICKBOOKS_ XERO_ SAGE_ FRESHBOOKS_ NETSUITE_ SAP_", "quickbooks xero sage freshbooks netsuite"),
    ("INFRA", "REDIS_ MEMCACHED_ RABBITMQ_ KAFKA_ ELASTIC_ ELASTICSEARCH_ MONGO_ MONGODB_", "redis memcached rabbitmq kafka elasticsearch mongodb"),
)


def external_systems(facts: DataFrame, channel: str = "channel", value: str = "value") -> DataFrame:
    """``category, channels, hits``: kinds of systems told by ``env_var`` (begins with), ``class_name`` and ``service_dep`` (holds) facts."""
    rows = [(c, k, s) for c, env, words in EXTERNAL for k, some in (("env_var", env), ("class_name", words), ("service_dep", words)) for s in some.split()]
    signs = facts.sparkSession.createDataFrame(rows, "category string, kind string, sign string")  # a short fixed list
    meets = F.when(F.col("kind") == "env_var", F.startswith(F.upper(value), F.col("sign"))).otherwise(F.contains(F.lower(value), F.col("sign")))
    hit = facts.join(F.broadcast(signs), (F.col(channel) == F.col("kind")) & meets)
    return hit.groupBy("category").agg(F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("channels"), F.count_distinct(channel, value).alias("hits"))


def gaps(items: DataFrame, group: str, hit: str) -> DataFrame:
    """Groups without any hit, largest first by ``items, group``."""
    return items.groupBy(group).agg(F.max(hit).alias("h"), F.count("*").alias("items")).where(~F.col("h")).drop("h")


def actor(path: Column, symbol: Column, auths: Column) -> Column:
    """Who acts, by the route or symbol and by the kinds of authorisation seen (an array)."""
    has = lambda *kinds: F.arrays_overlap(auths, F.array(*map(F.lit, kinds)))
    place = F.lower(F.concat_ws(" ", path, symbol))
    return ladder([
        (place.rlike(r"[/._-](admin|backend|staff|manager|superuser)"), "Admin"),
        (has("api_token", "jwt", "oauth_token") & ~has("session_check", "get_user"), "API Client"),
        (F.size(auths) > 0, "Authenticated User"),
    ], "Guest")


def rank_rules(rules: DataFrame, order: list) -> DataFrame:
    """Rules with a score in order; if none has any, all by confidence and id."""
    some = rules.agg(F.max("score").alias("__max"))
    both = rules.crossJoin(F.broadcast(some)).where((F.col("score") > 0) | (F.coalesce("__max", F.lit(0.0)) <= 0)).drop("__max")
    return both.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
