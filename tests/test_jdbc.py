"""Transactional JDBC writers against a stand-in: plain Python tables that
know the few statements the writers send. No database was used."""

import copy
import re

import pytest

from lotcast.sinks.jdbc import LEDGER, jdbc_transaction_writer, replace_table


class _Dead(Exception):
    pass


class _Tables:
    """Committed tables (name -> (columns, rows)). Every call that a writer
    makes counts as a step; ``die_at`` is the step at which it dies.
    ``seen`` holds what a reader of ``watched`` finds after each step."""

    def __init__(self, watched, ddl_commits=False):
        self.tables, self.watched, self.ddl_commits = {}, watched, ddl_commits
        self.steps, self.die_at, self.seen = 0, None, []

    def step(self):
        self.steps += 1
        if self.steps == self.die_at:
            raise _Dead(self.steps)

    def look(self):
        self.seen.append(self.rows(self.watched))

    def rows(self, table):
        return sorted(self.tables[table][1]) if table in self.tables else None

    def write(self, df, target, fmt, mode, options):
        """As Spark's writer: rows come in one by one, each committed."""
        self.step()
        rows = [tuple(r) for r in df.collect()]
        if mode == "overwrite" or target not in self.tables:
            self.tables[target] = (df.columns, [])
            self.look()
        for r in rows:
            self.step()
            self.tables[target][1].append(r)
            self.look()

    def connect(self, spark, options):
        self.step()
        return _Connection(self)


class _Connection:
    def __init__(self, db):
        self.db, self.held = db, copy.deepcopy(db.tables)

    def getMetaData(self):
        return self

    def getIdentifierQuoteString(self):
        return '"'

    def getTables(self, catalog, schema, name, types):
        self.found = (f"{schema}.{name}" if schema else name) in self.held
        return self

    def next(self):
        return self.found

    def setAutoCommit(self, on):
        assert not on

    def commit(self):
        self.db.step()
        self.db.tables = copy.deepcopy(self.held)
        self.db.look()

    def rollback(self):
        self.held = None

    def close(self):
        pass

    def prepareStatement(self, sql):
        self.db.step()
        return _Statement(self, sql)


class _Statement:
    def __init__(self, conn, sql):
        self.conn, self.sql, self.values = conn, sql, {}

    def setLong(self, i, v):
        self.values[i] = v

    setString = setLong

    def close(self):
        pass

    def executeQuery(self):
        assert self.sql == f"SELECT max(batch_id) FROM {LEDGER} WHERE stream_id = ? AND table_name = ?"
        found = [r[2] for r in self.conn.held[LEDGER][1] if r[:2] == (self.values[1], self.values[2])]
        self.value = max(found, default=None)
        return self

    def next(self):
        return True

    def getLong(self, i):
        return self.value or 0

    def wasNull(self):
        return self.value is None

    def executeUpdate(self):
        held, sql = self.conn.held, self.sql
        if m := re.fullmatch(r"INSERT INTO (\S+) \((.*)\) SELECT \2 FROM (\S+)", sql):
            assert [c.strip('"') for c in m[2].split(", ")] == list(held[m[3]][0])
            held[m[1]][1].extend(held[m[3]][1])
        elif m := re.fullmatch(r"DELETE FROM (\S+) WHERE stream_id = \? AND table_name = \?", sql):
            held[m[1]][1][:] = [r for r in held[m[1]][1] if r[:2] != (self.values[1], self.values[2])]
        elif m := re.fullmatch(r"INSERT INTO (\S+) \(stream_id, table_name, batch_id\) VALUES \(\?, \?, \?\)", sql):
            held[m[1]][1].append((self.values[1], self.values[2], self.values[3]))
        elif m := re.fullmatch(r"DELETE FROM (\S+)", sql):
            held[m[1]][1].clear()
        elif m := re.fullmatch(r"DROP TABLE (\S+)", sql):
            del held[m[1]]
        elif sql.startswith(("RENAME TABLE ", "ALTER TABLE ")):
            for a, b in re.findall(r"(\S+) (?:RENAME )?TO ([^\s,]+)", sql):
                schema = a.rpartition(".")[0]
                b = b if "." in b or not schema or sql.startswith("RENAME") else f"{schema}.{b}"
                assert b not in held
                held[b] = held.pop(a)
        else:
            raise AssertionError(sql)
        if self.conn.db.ddl_commits and sql.startswith(("DROP", "RENAME", "ALTER")):
            self.conn.db.tables = copy.deepcopy(held)
            self.conn.db.look()


@pytest.fixture(scope="module")
def batches(spark):
    return [spark.createDataFrame([(10 * b + i,) for i in range(2)], "x int").cache() for b in range(2)]


def _expected(stream, batch_ids):
    return sorted((10 * b + i, stream, b) for b in batch_ids for i in range(2))


def _run(db, batches, stream="streamone", ids=(0, 1)):
    write = jdbc_transaction_writer("shop.scores", {"url": "jdbc:x"}, stream, connect=db.connect, write=db.write)
    for b in ids:
        write(batches[b], b)


def test_a_batch_is_there_wholly_and_once_whatever_step_fails(spark, batches):
    clean = _Tables("shop.scores")
    _run(clean, batches)
    assert clean.rows("shop.scores") == _expected("streamone", (0, 1))
    fine = [None, [], _expected("streamone", (0,)), _expected("streamone", (0, 1))]
    assert all(s in fine for s in clean.seen)
    for step in range(1, clean.steps + 1, 2 if clean.steps > 40 else 1):
        db = _Tables("shop.scores")
        db.die_at = step
        with pytest.raises(_Dead):
            _run(db, batches)
        done = 0 if db.rows(LEDGER) in (None, []) else db.rows(LEDGER)[0][2] + 1
        db.die_at = None
        _run(db, batches, ids=range(max(0, done - 1), 2))  # Spark runs the last batch again
        assert db.rows("shop.scores") == _expected("streamone", (0, 1)), step
        assert all(s in fine for s in db.seen), step
        assert db.rows(LEDGER) == [("streamone", "shop.scores", 1)]


def test_streams_keep_their_own_numbers(spark, batches):
    db = _Tables("shop.scores")
    _run(db, batches, "streamone")
    _run(db, batches, "otherstream")  # a new checkpoint counts from 0 again
    _run(db, batches, "streamone", ids=(1,))
    assert db.rows("shop.scores") == sorted(_expected("streamone", (0, 1)) + _expected("otherstream", (0, 1)))
    assert len(db.rows(LEDGER)) == 2


@pytest.mark.parametrize("url,ddl_commits", [("jdbc:mysql://h/db", True), ("jdbc:postgresql://h/db", False), ("jdbc:h2:x", True)])
@pytest.mark.parametrize("there", [True, False])
def test_a_table_is_replaced_without_a_gap(spark, batches, url, ddl_commits, there):
    def fresh():
        db = _Tables("shop.board", ddl_commits)
        if there:
            db.tables["shop.board"] = (["x"], [(-1,)])
        return db

    def run(db):
        replace_table(batches[1], "shop.board", {"url": url}, connect=db.connect, write=db.write)

    old, new = [(-1,)] if there else None, [(10,), (11,)]
    allowed = [old, new] + ([[]] if not there else [])  # a table that was never there may be made empty first
    clean = fresh()
    run(clean)
    assert clean.rows("shop.board") == new and set(clean.tables) == {"shop.board"}
    assert all(s in allowed for s in clean.seen)
    for step in range(1, clean.steps + 1):
        db = fresh()
        db.die_at = step
        with pytest.raises(_Dead):
            run(db)
        assert db.rows("shop.board") in allowed, step
        db.die_at = None
        run(db)
        assert db.rows("shop.board") == new and all(s in allowed for s in db.seen), step
        assert set(db.tables) == {"shop.board"}, step


def test_the_sink_swaps_only_when_asked(spark, batches, monkeypatch):
    from lotcast.plans import listing_jobs
    done = []
    monkeypatch.setattr(listing_jobs, "replace_table", lambda df, t, o: done.append(("swap", t)))
    monkeypatch.setattr(listing_jobs, "write_table", lambda df, t, *a: done.append(("write", t)))
    for swap in (False, True):
        listing_jobs.Sink("jdbc", options={"url": "u"}, swap=swap).write(batches[0], "board")
    listing_jobs.Sink("jdbc", options={"url": "u"}, swap=True).write(batches[0], "board", mode="append")
    assert done == [("write", "board"), ("swap", "board"), ("write", "board")]
