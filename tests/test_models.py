"""The registered model queries run the configured trials, trees and features."""
from fraudlake.operators import model
from fraudlake.plans import queries

#: The configured features (fixed values).
CONFIGURED = (
    "amount use_chip merchant_state mcc errors has_chip num_credit_cards card_brand card_type num_cards_issued credit_limit "
    "year_pin_last_changed acct_opened_months yrs_since_pin_changed per_capita_income credit_score yearly_income"
).split()


def test_configured_features_and_trials(spark):
    assert sorted(queries.MODEL_NUMERIC + queries.MODEL_CATEGORICAL) == sorted(CONFIGURED) and queries.MODEL_TRIALS == 10
    df = queries._labelled_gold(spark, "/root/testdata/sf0.001")
    assert set(CONFIGURED) <= set(df.columns)


def test_boosted_trees_are_as_drawn(spark, monkeypatch):
    class Stop(Exception):
        pass

    def fit_final(train, label, id_col, num, cat, name, params, seed):
        assert 100 <= params["n_estimators"] <= 500
        raise Stop

    monkeypatch.setattr(queries, "_model_frames", lambda spark, d: (None, None, None))
    monkeypatch.setattr(model, "fit_final", fit_final)
    try:
        queries.gbt_eval(spark, "")
    except Stop:
        return
    raise AssertionError("no fit")
