"""The simulator's entities in SQL, over the same fixed values: what its queries are held against."""

from __future__ import annotations

from vigilake.config import SimulatorSettings
from vigilake.plans import simulate as sim


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def uniform(seed: int, tag: str, key: str) -> str:
    return f"(('0x' || substr(md5('{seed}|{tag}|' || CAST({key} AS VARCHAR)), 1, 13))::BIGINT / 4503599627370496::DOUBLE)"


def pick(u: str, values: list) -> str:
    items = ", ".join(_text(v) if isinstance(v, str) else str(v) for v in values)
    return f"([{items}])[1 + CAST(floor({u} * {len(values)}) AS INTEGER)]"


def weighted(u: str, choices: list[tuple[str, float]]) -> str:
    total, at, cases = sum(w for _, w in choices), 0.0, []
    for value, weight in choices[:-1]:
        at += weight
        cases.append(f"WHEN {u} < {at / total!r}::DOUBLE THEN {_text(value)}")
    return f"CASE {' '.join(cases)} ELSE {_text(choices[-1][0])} END"


def _case(of: str, values: dict[str, str]) -> str:
    return f"CASE {of} " + " ".join(f"WHEN {_text(k)} THEN {v}" for k, v in values.items()) + " END"


def cents(value: str) -> str:
    return f"(floor(({value}) * 100 + 0.5::DOUBLE) / 100::DOUBLE)"


def _normal(a: str, b: str) -> str:
    return f"(sqrt(-2 * ln(1 - {a})) * cos(2 * pi() * {b}))"


def customers(s: SimulatorSettings = SimulatorSettings()) -> str:
    u = lambda tag: uniform(s.seed, tag, "id")
    of = lambda values, i: _case("customer_segment", {k: f"{float(v[i])!r}::DOUBLE" for k, v in values.items()})
    place = lambda i: f"CASE WHEN id % 10 = 0 THEN {pick(u('abroad'), [p[i] for p in sim.FOREIGN])} ELSE {pick(u('home'), [p[i] for p in sim.INDIAN_PLACES]) if i < 2 else _text('India')} END"
    income = cents(f"{of(sim.INCOME, 0)} + {u('income')} * ({of(sim.INCOME, 1)} - {of(sim.INCOME, 0)})")
    body = f"{pick(u('brand'), ['4', '5'])} || lpad(CAST(CAST(floor({u('card')} * 100000000000000) AS BIGINT) AS VARCHAR), 14, '0')"
    digit = "CAST(substr(body, CAST(j AS INTEGER), 1) AS INTEGER)"
    check = f"CAST((10 - list_sum(list_transform(range(1, 16), lambda j: CASE WHEN j % 2 = 1 THEN (2 * {digit}) // 10 + (2 * {digit}) % 10 ELSE {digit} END)) % 10) % 10 AS VARCHAR)"
    return f"""SELECT printf('CUST%06d', id) AS customer_id, {pick(u('first'), sim.FIRST_NAMES)} AS first_name, {pick(u('last'), sim.LAST_NAMES)} AS last_name,
  {pick(u('gender'), sim.GENDERS)} AS gender, CAST(18 + floor({u('age')} * 58) AS INTEGER) AS age, city, state, country, annual_income, customer_segment,
  strftime(DATE '2024-01-01' - CAST(floor({u('opened')} * 2920) AS INTEGER), '%Y-%m-%d') AS account_open_date,
  CAST(greatest(5, least(100, trunc(35 + 18 * {_normal(u('risk1'), u('risk2'))}))) AS DOUBLE) AS risk_score,
  {cents(f"annual_income * {of(sim.SPENDING, 0)} / 12")} AS preferred_spending_min, {cents(f"annual_income * {of(sim.SPENDING, 1)} / 12")} AS preferred_spending_max,
  city AS preferred_city, country AS preferred_country, printf('DEV%04d', id) AS trusted_device_id, body || {check} AS card_number, {pick(u('type'), sim.CARD_TYPES)} AS card_type,
  'customer' || id || '@example.com' AS email, {cents(f"annual_income * {of(sim.SPENDING, 1)}")} AS transaction_limit
FROM (SELECT *, {income} AS annual_income FROM (SELECT id, {weighted(u('segment'), sim.SEGMENTS)} AS customer_segment, {place(0)} AS city, {place(1)} AS state, {place(2)} AS country, {body} AS body
  FROM (SELECT unnest(range(1, {s.customers + 1})) AS id)))"""


def merchants(s: SimulatorSettings = SimulatorSettings()) -> str:
    u = lambda tag: uniform(s.seed, f"m-{tag}", "id")
    category = f"({[*sim.CATEGORIES]})[1 + id % {len(sim.CATEGORIES)}]"
    return f"""SELECT printf('MER%04d', id) AS merchant_id, {_case('merchant_category', {c: pick(u('name'), own) for c, own in sim.SHOPS.items()})} || ' ' || id AS merchant_name, merchant_category,
  CASE WHEN id % 15 = 0 THEN {pick(u('abroad'), [p[0] for p in sim.FOREIGN])} ELSE {pick(u('home'), sim.MERCHANT_CITIES)} END AS city,
  CASE WHEN id % 15 = 0 THEN {pick(u('abroad'), [p[2] for p in sim.FOREIGN])} ELSE 'India' END AS country,
  {weighted(u('risk'), [('LOW', 0.65), ('MEDIUM', 0.25), ('HIGH', 0.10)])} AS merchant_risk, id % 20 = 0 AS is_blacklisted
FROM (SELECT id, {category} AS merchant_category FROM (SELECT unnest(range(1, {s.merchants + 1})) AS id))"""


def transactions(numbers: str, s: SimulatorSettings = SimulatorSettings()) -> str:
    """numbers: SQL that gives seq."""
    u = lambda tag: uniform(s.seed, f"t-{tag}", "seq")
    n = len(sim.CATEGORIES)
    low, high = "preferred_spending_min", "preferred_spending_max"
    kinds = lambda values: ", ".join(map(_text, values))
    amount = f"""CASE WHEN merchant_category IN ({kinds(sim.TRAVEL)}) THEN (0.6::DOUBLE + {u('amount')} * (1.8::DOUBLE - 0.6::DOUBLE)) * {high}
    WHEN merchant_category IN ({kinds(sim.SHOPPING)}) THEN 0.8::DOUBLE * {low} + {u('amount')} * (1.2::DOUBLE * {high} - 0.8::DOUBLE * {low})
    WHEN merchant_category = 'ATM' THEN 500 + {u('amount')} * 4500
    ELSE greatest(50::DOUBLE, least(({low} + {high}) / 2 + {_normal(u('n1'), u('n2'))} * ({high} - {low}) / 5, 2 * {high})) END"""
    return f"""WITH sim_c AS ({customers(s)}), sim_m AS (SELECT *, (CAST(substr(merchant_id, 4) AS BIGINT) - 1) // {n} AS rank FROM ({merchants(s)})),
  sim_sizes AS (SELECT merchant_category, max(rank) AS top, min(rank) AS low FROM sim_m GROUP BY ALL),
  sim_t AS (SELECT seq, sim_c.*, {_case('customer_segment', {k: pick(u('category'), own) for k, own in sim.PREFERRED.items()})} AS wanted
    FROM ({numbers}) JOIN sim_c ON sim_c.customer_id = printf('CUST%06d', 1 + CAST(floor({u('customer')} * {s.customers}) AS BIGINT))),
  sim_r AS (SELECT *, low + CAST(floor({u('merchant')} * (top - low + 1)) AS BIGINT) AS own_rank FROM sim_t JOIN sim_sizes ON wanted = merchant_category)
SELECT seq, printf('TXN%07d', seq) AS transaction_id, customer_id, card_number, merchant_id, merchant_name, merchant_category, {cents(amount)} AS amount,
  CASE WHEN country <> preferred_country AND {u('foreign')} < 0.5 THEN {pick(u('currency'), ['USD', 'EUR'])} ELSE 'INR' END AS currency,
  CASE WHEN merchant_category = 'ATM' THEN 'ATM' WHEN merchant_category IN ({kinds(sim.ONLINE)}) THEN {pick(u('kind'), ['PURCHASE', 'ONLINE'])} ELSE 'PURCHASE' END AS transaction_type,
  CASE WHEN merchant_category = 'ATM' THEN 'ATM' ELSE {pick(u('channel'), sim.CHANNELS)} END AS payment_channel,
  CASE WHEN {u('device')} < 0.15::DOUBLE THEN printf('DEV%04d', 1000 + CAST(floor({u('other')} * 9000) AS BIGINT)) ELSE trusted_device_id END AS device_id, city, country,
  TIMESTAMP '{sim.EPOCH}' + to_microseconds(CAST(seq * {1_000_000 / s.transactions_per_second!r}::DOUBLE AS BIGINT)) AS transaction_timestamp, country <> preferred_country AS is_international, 'APPROVED' AS status
FROM (SELECT r.* EXCLUDE (merchant_category, city, country, state), m.merchant_id, m.merchant_name, m.merchant_category, m.city, m.country FROM sim_r r JOIN sim_m m ON m.merchant_category = r.wanted AND m.rank = r.own_rank)"""


def normal_amount(seed: int = 42) -> str:
    return cents(f"1 + {uniform(seed, 'feed', 'seq')} * 99998.99::DOUBLE")
