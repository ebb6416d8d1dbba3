"""Dialogues as utterances, hosts, backchannels and units of rendering manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.functions import text as X
from turnloom.operators import rendering as R
from turnloom.operators import slots as S
from turnloom.plans import slots as P
from turnloom.plans.common import q, sql_align, sql_cut, sql_sanitize_text, sql_strip
from turnloom.registry import Registry

registry = Registry()


def _picked(*key) -> Column:
    """A backchannel of the pool, by the hash of a key."""
    h = F.conv(F.substring(F.md5(F.concat_ws("|", *[k.cast("string") for k in key])), 1, 8), 16, 10).cast("bigint")
    return F.element_at(F.array(*map(F.lit, X.BACKCHANNELS)), (h % len(X.BACKCHANNELS) + 1).cast("int"))


def _sql_picked(*key: str) -> str:
    pool = ", ".join(map(q, X.BACKCHANNELS))
    h = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in key)
    return f"([{pool}])[CAST(CAST(('0x' || substr(md5({h}), 1, 8)) AS UBIGINT) % {len(X.BACKCHANNELS)} + 1 AS BIGINT)]"


def said(spark, sf_dir) -> DataFrame:
    """The utterances of every dialogue, whose backchannels have the words they fall back on."""
    rows = P.decided_turns(spark, sf_dir)
    back = F.filter("decisions", lambda d: d["decision"] == "backchannel")
    contents = F.transform(back, lambda d: _picked(F.col("record_id"), F.col("turn"), d["word_index"]))
    rows = rows.select("record_id", "turn", "role", S.reconstructed(F.col("words"), F.col("decisions")).alias("s"), contents.alias("contents"))
    return R.utterances(rows, "record_id", "turn", "role", "s", F.col("contents"), _picked(F.col("record_id"), F.col("turn")))


SQL_SAID = P.SQL_FOLD + f""", tok AS (SELECT x.record_id, x.turn, x.role, x.word_index, x.word || CASE f.decision WHEN 'floor_taking' THEN ' [TAKE_FLOOR]' WHEN 'backchannel' THEN ' [BACKCHANNEL]' ELSE '' END AS t FROM x LEFT JOIN fold f ON f.record_id = x.record_id AND f.turn = x.turn AND f.word_index = x.word_index WHERE x.role IS NOT NULL),
txt AS (SELECT record_id, turn, role, string_agg(t, ' ' ORDER BY word_index) AS s FROM tok GROUP BY ALL),
san AS (SELECT record_id, turn, role, {sql_sanitize_text('s')} AS s FROM txt),
cutt AS (SELECT record_id, turn, role, contains(s, '[TAKE_FLOOR]') AS taken, {sql_cut('s')} AS s FROM san),
bcs AS (SELECT record_id, turn, list({_sql_picked('record_id', 'turn', 'word_index')} ORDER BY word_index) AS cs FROM fold WHERE decision = 'backchannel' GROUP BY record_id, turn),
par AS (SELECT c.record_id, c.turn, role, taken, string_split(s, '[BACKCHANNEL]') AS ps, cs FROM cutt c LEFT JOIN bcs USING (record_id, turn)),
pie AS (SELECT *, unnest(generate_series(1, len(ps))) AS i FROM par),
seg AS (SELECT record_id, turn, role, taken, 2 * i AS k, false AS is_bc, {sql_strip("replace(replace(trim(ps[i], ' ,'), '[BACKCHANNEL]', ''), '[TAKE_FLOOR]', '')")} AS text FROM pie
  UNION ALL SELECT record_id, turn, role, taken, 2 * i + 1, true, coalesce(cs[i], {_sql_picked('record_id', 'turn')}) FROM pie WHERE i < len(ps)),
num AS (SELECT *, row_number() OVER (PARTITION BY record_id, turn ORDER BY k) - 1 AS seg, row_number() OVER (PARTITION BY record_id ORDER BY turn, k) - 1 AS idx FROM seg WHERE is_bc OR text <> ''),
trg AS (SELECT *, taken AND seg = max(CASE WHEN NOT is_bc THEN seg END) OVER (PARTITION BY record_id, turn) AS cuts FROM num),
utt AS (SELECT record_id, turn, seg, idx, role, text, CASE WHEN lag(cuts) OVER w AND lag(role) OVER w <> role THEN 'interrupt' WHEN is_bc THEN 'backchannel' END AS uttr_type FROM trg WINDOW w AS (PARTITION BY record_id ORDER BY idx))"""


@registry.query("t16_utterances", SQL_SAID + " SELECT record_id, turn, CAST(seg AS INTEGER) AS seg, CAST(idx AS INTEGER) AS idx, role, uttr_type, text FROM utt")
def t16_utterances(spark, sf_dir):
    """Dialogues as utterances: sanitised, cut after the floor is taken, with their backchannels and interrupts."""
    return said(spark, sf_dir)


@registry.query("w13_interrupts", SQL_SAID + " SELECT record_id, turn, CAST(seg AS INTEGER) AS seg, role FROM utt WHERE uttr_type = 'interrupt'")
def w13_interrupts(spark, sf_dir):
    """The utterances that interrupt: the other speaker's, right after a floor was taken."""
    return said(spark, sf_dir).where("uttr_type = 'interrupt'").select("record_id", "turn", "seg", "role")


#: hst and bck: the hosts and backchannels of each dialogue, by a fold over its utterances.
SQL_MANI = SQL_SAID + f""", ord AS MATERIALIZED (SELECT record_id, idx AS i, uttr_type AS typ, text, {sql_strip("regexp_replace(text, '" + X.MASKS + "', '', 'g')")} NOT IN ('', '-', '...', '.', ',') AS said, {sql_align('text')} AS wc,
  (idx + CASE WHEN first_value(role) OVER (PARTITION BY record_id ORDER BY idx) = 'assistant' THEN 1 ELSE 0 END) % 2 AS me, CASE WHEN lead(idx) OVER w IS NULL THEN 'last' ELSE lead(uttr_type) OVER w END AS nxt FROM utt WINDOW w AS (PARTITION BY record_id ORDER BY idx)),
st AS (SELECT record_id, CAST(-1 AS BIGINT) AS i, 'first' AS prev, CAST([] AS BIGINT[]) AS p0, CAST([] AS BIGINT[]) AS p1, CAST(0 AS BIGINT) AS w0, CAST(0 AS BIGINT) AS w1, false AS a0, false AS a1, false AS x0, false AS x1, CAST([] AS BIGINT[]) AS live, CAST(0 AS BIGINT) AS hosts,
  CAST([] AS BIGINT[]) AS parts, CAST(0 AS BIGINT) AS me, NULL::VARCHAR AS ut, NULL::VARCHAR AS nxt, CAST(NULL AS BIGINT) AS bc_wc, false AS flush FROM (SELECT DISTINCT record_id FROM ord)
  UNION ALL SELECT * FROM (
    WITH j AS (SELECT s.*, o.i AS oi, o.typ, o.said, o.wc, o.me AS om, o.nxt AS onx, o.said AND o.typ IS NOT DISTINCT FROM 'backchannel' AS bc, CASE WHEN o.me = 0 THEN s.x0 ELSE s.x1 END OR coalesce(o.typ = 'interrupt', false) AS xm,
        CASE WHEN s.prev IS NOT DISTINCT FROM 'backchannel' THEN CASE WHEN o.me = 0 THEN s.p0 ELSE s.p1 END ELSE CAST([] AS BIGINT[]) END AS kept, CASE WHEN s.prev IS NOT DISTINCT FROM 'backchannel' THEN CASE WHEN o.me = 0 THEN s.w0 ELSE s.w1 END ELSE 0 END AS kw
      FROM st s JOIN ord o ON o.record_id = s.record_id AND o.i = s.i + 1),
    k AS (SELECT *, CASE WHEN bc THEN false WHEN said THEN onx IS DISTINCT FROM 'backchannel' ELSE onx IS DISTINCT FROM 'backchannel' AND CASE WHEN om = 0 THEN a0 ELSE a1 END END AS fl,
        CASE WHEN said AND NOT bc THEN list_append(kept, oi) ELSE CASE WHEN om = 0 THEN p0 ELSE p1 END END AS pm, CASE WHEN said AND NOT bc THEN kw + wc ELSE CASE WHEN om = 0 THEN w0 ELSE w1 END END AS wm FROM j)
    SELECT record_id, oi, typ, CASE WHEN om = 1 THEN p0 WHEN fl THEN CAST([] AS BIGINT[]) ELSE pm END, CASE WHEN om = 0 THEN p1 WHEN fl THEN CAST([] AS BIGINT[]) ELSE pm END,
      CASE WHEN om = 1 THEN w0 WHEN fl THEN 0 ELSE wm END, CASE WHEN om = 0 THEN w1 WHEN fl THEN 0 ELSE wm END,
      CASE WHEN om = 1 THEN a0 WHEN fl THEN false ELSE a0 OR (said AND NOT bc) END, CASE WHEN om = 0 THEN a1 WHEN fl THEN false ELSE a1 OR (said AND NOT bc) END,
      CASE WHEN om = 1 THEN x0 WHEN fl THEN false ELSE xm END, CASE WHEN om = 0 THEN x1 WHEN fl THEN false ELSE xm END,
      CASE WHEN bc THEN list_append(live, oi) WHEN NOT said AND prev IS NOT DISTINCT FROM 'backchannel' AND len(live) > 0 THEN live[1:len(live) - 1] ELSE live END,
      hosts + CASE WHEN fl THEN 1 ELSE 0 END, pm, om, CASE WHEN xm THEN 'interrupt' END, onx, CASE WHEN bc THEN CASE WHEN om = 0 THEN w1 ELSE w0 END END, fl FROM k)),
fin AS (SELECT record_id, arg_max(live, i) AS live, max(hosts) AS n FROM st GROUP BY record_id),
hst AS (SELECT record_id, hosts - 1 AS host_idx, i AS turn, me AS speaker_idx, ut AS uttr_type, nxt AS next_uttr_type, parts FROM st WHERE flush),
bck AS (SELECT st.record_id, list_position(fin.live, i) - 1 AS bc_idx, me AS speaker_idx, i, bc_wc AS word_count, least(hosts, n - 1) AS host_idx FROM st JOIN fin USING (record_id) WHERE bc_wc IS NOT NULL AND list_contains(fin.live, i))"""


def hosts(spark, sf_dir) -> DataFrame:
    """The hosts of every dialogue's manifest, a row each."""
    rows = R.manifests(said(spark, sf_dir), "record_id", "role")
    return rows.select("record_id", F.explode("hosts").alias("h")).select("record_id", "h.*")


_HOSTS = f"tts AS (SELECT h.record_id, host_idx, {sql_strip("string_agg(o.text, ' ' ORDER BY o.i)")} AS tts_text FROM (SELECT record_id, host_idx, unnest(parts) AS i FROM hst) h JOIN ord o ON o.record_id = h.record_id AND o.i = h.i GROUP BY h.record_id, host_idx)"


@registry.query("w8_accumulated_hosts", f"{SQL_MANI}, {_HOSTS} SELECT record_id, CAST(host_idx AS INTEGER) AS host_idx, CAST(turn AS INTEGER) AS turn, CAST(speaker_idx AS INTEGER) AS speaker_idx, uttr_type, next_uttr_type, tts_text FROM hst JOIN tts USING (record_id, host_idx)")
def w8_accumulated_hosts(spark, sf_dir):
    """Hosts: what one channel says, gathered across the backchannels that interrupt it."""
    return hosts(spark, sf_dir)


@registry.query("t17_manifest", f"""{SQL_MANI} SELECT b.record_id, CAST(bc_idx AS INTEGER) AS bc_idx, CAST(b.speaker_idx AS INTEGER) AS speaker_idx, CASE WHEN lower({sql_strip(f"regexp_replace(o.text, {q(X.TAG)}, '', 'g')")}) IN ({', '.join(map(q, X.RISING))}) THEN rtrim(o.text) || '?' ELSE o.text END AS text, CAST(word_count AS INTEGER) AS word_count, CAST(b.host_idx AS INTEGER) AS host_idx, h.next_uttr_type AS next_uttr_type_of_host
FROM bck b JOIN ord o ON o.record_id = b.record_id AND o.i = b.i LEFT JOIN hst h ON h.record_id = b.record_id AND h.host_idx = b.host_idx""")
def t17_manifest(spark, sf_dir):
    """The backchannels of every dialogue's manifest: channel, anchor word and host."""
    rows = R.manifests(said(spark, sf_dir), "record_id", "role")
    return rows.select("record_id", F.explode("backchannels").alias("b")).select("record_id", "b.*")


_UNITS = f"""{SQL_MANI}, {_HOSTS}, bare AS (SELECT record_id, host_idx, {sql_strip(f"regexp_replace(regexp_replace(tts_text, {q(X.TAG)}, '', 'g'), '{X.MASKS}', '', 'g')")} AS s FROM tts),
sen AS (SELECT record_id, host_idx, unnest(ss) AS t, generate_subscripts(ss, 1) AS j FROM (SELECT record_id, host_idx, string_split(regexp_replace(s, '([.?!])\\s+', '\\1' || chr(1), 'g'), chr(1)) AS ss FROM bare)),
pcs AS (SELECT record_id, host_idx, j, unnest(ps) AS t, generate_subscripts(ps, 1) AS k, len(ps) AS n FROM (SELECT record_id, host_idx, j, string_split({sql_strip('t')}, '[PAUSE]') AS ps FROM sen WHERE {sql_strip('t')} <> '')),
fla AS (SELECT record_id, host_idx, j, 2 * k AS k, 'text' AS kind, {sql_strip('t')} AS text FROM pcs WHERE {sql_strip('t')} <> '' UNION ALL SELECT record_id, host_idx, j, 2 * k + 1, 'pause', '' FROM pcs WHERE k < n)
SELECT record_id, CAST(host_idx AS INTEGER) AS host_idx, kind, 'u_' || host_idx || '_' || (row_number() OVER (PARTITION BY record_id, host_idx ORDER BY j, k) - 1) AS unit_id, text FROM fla"""


@registry.query("t18_units", _UNITS)
def t18_units(spark, sf_dir):
    """Hosts as units: sentences and the pauses in them."""
    rows = hosts(spark, sf_dir).select("record_id", "host_idx", F.explode(R.units(F.col("tts_text"), F.col("host_idx"))).alias("u"))
    return rows.select("record_id", "host_idx", "u.kind", "u.unit_id", "u.text")
