"""S3-compatible object store settings from the environment.

Returns ``spark.hadoop.fs.s3a.*`` settings as a dict (applied when a session
is built); nothing is contacted here.
"""

from __future__ import annotations

from collections.abc import Mapping

# Environment variable names read for the object store.
ENV_ENDPOINT = "S3_ENDPOINT_URL"
ENV_ACCESS_KEY = "AWS_ACCESS_KEY_ID"
ENV_SECRET_KEY = "AWS_SECRET_ACCESS_KEY"
ENV_BUCKET = "S3_BUCKET"


def s3a_conf(env: Mapping[str, str]) -> dict[str, str]:
    conf = {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.fast.upload": "true",
        # Write through the magic committer: no rename-based commit on S3.
        "spark.hadoop.fs.s3a.committer.name": "magic",
        "spark.hadoop.fs.s3a.committer.magic.enabled": "true",
    }
    endpoint = env.get(ENV_ENDPOINT)
    if endpoint:
        conf["spark.hadoop.fs.s3a.endpoint"] = endpoint
        conf["spark.hadoop.fs.s3a.path.style.access"] = "true"
        conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] = str(endpoint.startswith("https")).lower()
    if env.get(ENV_ACCESS_KEY):
        conf["spark.hadoop.fs.s3a.access.key"] = env[ENV_ACCESS_KEY]
    if env.get(ENV_SECRET_KEY):
        conf["spark.hadoop.fs.s3a.secret.key"] = env[ENV_SECRET_KEY]
    return conf


def lake_uri(env: Mapping[str, str], *parts: str) -> str:
    """``s3a://<bucket>/<parts>`` — keys never start with '/'."""
    bucket = env.get(ENV_BUCKET, "lake")
    key = "/".join(p.strip("/") for p in parts if p)
    return f"s3a://{bucket}/{key}"
