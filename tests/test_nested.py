from siltloom.operators import nested


def test_forms_of_dependencies(spark, rows):
    texts = [
        (1, '{"imports": [{"name": "A"}, null, {"component_name": "B"}, {"name": ""}], "variables": null}', "extra"),
        (2, '"{\\"functions\\": [{\\"name\\": \\"f\\"}]}"', None),
        (3, '{"dependencies": {"classes": {"name": "C"}}, "dependencies_processed": true}', None),
        (4, '{"imports": [\x01{"name": "D"}],}', None),
        (5, '{"interfaces": ["I", "J"]}', None),
        (6, "undefined", None),
        (7, None, None),
        (8, "[]", None),
        (9, "", None),
        (10, "null", None),
    ]
    df = spark.createDataFrame(texts, "unit_id long, dependencies string, path string")
    got = rows(nested.dependency_rows(df, "unit_id").select("row_id", "path", "parent_pos", "pos", "child_name"))
    assert got == sorted(
        [
            (1, "dependencies.imports", -1, 0, "A"),
            (1, "dependencies.imports", -1, 2, "B"),
            (1, "dependencies.imports", -1, 3, ""),
            (2, "dependencies.functions", -1, 0, "f"),
            (3, "dependencies.classes", -1, 0, "C"),
            (4, "dependencies.imports", -1, 0, "D"),
            (5, "dependencies.interfaces", -1, 0, "I"),
            (5, "dependencies.interfaces", -1, 1, "J"),
        ],
        key=repr,
    )


def test_variables_and_their_parts(spark, rows):
    ref = "struct<ref_type:string,module_name:string,name:string,id:string>"
    deps = f"struct<imports:array<{ref}>,variables:array<{ref}>,functions:array<{ref}>,classes:array<{ref}>,interfaces:array<{ref}>>"
    schema = f"analysis_id long, imports array<struct<import_type:string,module_name:string,full_import:string,name:string,component_name:string,alias:string,component_content:string,resolved_file:string>>, variables array<struct<modifiers:array<string>,name:string,type:string,value:string,full_variable:string,dependencies:{deps}>>"
    imp = lambda n, c: (None, "m", None, n, c, None, None, None)
    data = [
        (1, [imp("a", None), None, imp(None, "b"), imp(None, None)], [None, (["@State", None, "private"], "v", "t", None, None, ([(None, None, "x", None), None], None, [], None, None)), (None, None, None, None, None, None)]),
        (2, None, None),
        (3, [], []),
    ]
    got = rows(nested.analysis_rows(spark.createDataFrame(data, schema)).select("row_id", "path", "parent_pos", "pos", "child_name"))
    assert got == sorted(
        [
            (1, "imports", -1, 0, "a"),
            (1, "imports", -1, 2, "b"),
            (1, "imports", -1, 3, ""),
            (1, "variables", -1, 1, "v"),
            (1, "variables", -1, 2, ""),
            (1, "variables.modifiers", 1, 0, "@State"),
            (1, "variables.modifiers", 1, 2, "private"),
            (1, "variables.dependencies.imports", 1, 0, "x"),
        ],
        key=repr,
    )


def test_empty_tables(spark):
    df = spark.createDataFrame([], "unit_id long, dependencies string")
    assert nested.dependency_rows(df, "unit_id").count() == 0
