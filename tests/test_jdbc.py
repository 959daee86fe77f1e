"""Connection options; no database is contacted."""

import pytest

from quarryline.sources import jdbc

SYSTEMS = {
    "Oracle": {"MySQL": {"Server": {"Group": {"Local": {"ServerName": "db", "ServerPort": "3306"}}}}},
    "MariaDB Foundation": {"MariaDB": {"Server": {"Group": {"Local": {"ServerName": "m", "ServerPort": 3307}}}}},
    "SAP": {"HANA": {"Server": {"Group": {"Production": {"ServerName": "h", "ServerPort": "30015"}}}}},
}

ACCOUNT = {"Name": "Someone", "Username": "u", "Password": "made-up"}


def _credentials(**extra):
    account = {"Default": {**ACCOUNT, **extra}}
    return {
        "Oracle": {"MySQL": {"Group": {"Local": account}}},
        "MariaDB Foundation": {"MariaDB": {"Group": {"Local": account}}},
        "SAP": {"HANA": {"Group": {"Production": account}}},
    }


def _sequence(vendor, kind, layer="Local"):
    return {
        "server-vendor": vendor, "server-type": kind, "server-group": "Group", "server-layer": layer,
        "account-label": "Default",
    }


@pytest.mark.parametrize(
    "sequence,url,driver",
    [
        (_sequence("Oracle", "MySQL"), "jdbc:mysql://db:3306/mysql?", "com.mysql.cj.jdbc.Driver"),
        (_sequence("MariaDB Foundation", "MariaDB"), "jdbc:mariadb://m:3307/mysql?", "org.mariadb.jdbc.Driver"),
        (_sequence("SAP", "HANA", "Production"), "jdbc:sap://h:30015/?", "com.sap.db.jdbc.Driver"),
    ],
)
def test_options(sequence, url, driver):
    options = jdbc.jdbc_options(jdbc.resolve_connection(sequence, SYSTEMS, _credentials()))
    assert options["url"].startswith(url)
    assert "ompress" in options["url"]
    assert (options["driver"], options["user"], options["password"]) == (driver, "u", "made-up")
    assert int(options["fetchsize"]) > 0


def test_secrets_from_the_environment(monkeypatch):
    credentials = _credentials(Password="SOME_VARIABLE", Storage={"Password": "environment variable", "Name": "file"})
    sequence = _sequence("Oracle", "MySQL")
    with pytest.raises(ValueError, match="SOME_VARIABLE"):
        jdbc.resolve_connection(sequence, SYSTEMS, credentials)
    monkeypatch.setenv("SOME_VARIABLE", "from outside")
    connection = jdbc.resolve_connection(sequence, SYSTEMS, credentials)
    assert connection.password == "from outside"
    assert "from outside" not in repr(connection)


def test_unknown_entries():
    with pytest.raises(ValueError, match="no JDBC dialect"):
        jdbc.resolve_connection(_sequence("Other", "DB"), SYSTEMS, _credentials())
    with pytest.raises(ValueError, match="source catalogue.*Elsewhere"):
        jdbc.resolve_connection(_sequence("SAP", "HANA", "Elsewhere"), SYSTEMS, _credentials())
    with pytest.raises(ValueError, match="credentials"):
        jdbc.resolve_connection(_sequence("SAP", "HANA", "Production"), SYSTEMS, {})
    incomplete = {"SAP": {"HANA": {"Group": {"Production": {"Default": {"Name": "x"}}}}}}
    with pytest.raises(ValueError, match="Username"):
        jdbc.resolve_connection(_sequence("SAP", "HANA", "Production"), SYSTEMS, incomplete)


def test_chopped_blanks(spark):
    frame = spark.sql("SELECT 'a  ' AS `x y`, ' b' AS z, 1 AS n")
    assert tuple(jdbc.chop_blanks(frame).first()) == ("a", " b", 1)
